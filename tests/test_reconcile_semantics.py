"""Hand-made cases for the reconciliation rules."""

import pytest

from helpers import alt_ids, lines_df, members, pos_line, txn_df, txn_row
from tallyspark.operators.delta import new_lines
from tallyspark.plans.reconcile import ReconcileInputs, gate, missed_lines


def _run(spark, lines, txns, mem=None, alt=None, history=None, kind=None):
    mem = mem if mem is not None else members(spark, [(1, "C1", "a@x.com")])
    alt = alt if alt is not None else alt_ids(spark, [])
    batch = lines_df(spark, lines)
    hist = lines_df(spark, history or [])
    inp = ReconcileInputs(batch, hist, mem, alt, txn_df(spark, txns))
    return missed_lines(inp, kind)


def test_exact_match_is_not_missed(spark):
    assert _run(spark, [pos_line()], [txn_row()]).count() == 0


@pytest.mark.parametrize("line_col,txn_col", [
    ("hd_store_id", "store"), ("hd_currency", "currency"), ("country", None),
    ("itm_amt_after_disc", "monetaryamount"), ("hd_order_date_time", "date")])
def test_null_key_never_matches(spark, line_col, txn_col):
    t = txn_row(**({txn_col: None} if txn_col else {"country": None}))
    assert _run(spark, [pos_line(**{line_col: None})], [t]).count() == 1


def test_null_loyalty_id_is_never_a_candidate(spark):
    assert _run(spark, [pos_line(hd_loyalty_id=None)], []).count() == 0


def test_unresolved_id_is_dropped(spark):
    assert _run(spark, [pos_line(hd_loyalty_id="C999")], []).count() == 0


def test_alternate_fan_out_keeps_one_line_per_alt_row(spark):
    alt = alt_ids(spark, [(1, "A7"), (2, "A7")])
    mem = members(spark, [(1, "C1", None), (2, "C2", None)])
    out = _run(spark, [pos_line(hd_loyalty_id="A7")], [txn_row(memberid=1)], mem=mem, alt=alt)
    assert out.count() == 1  # member 2's copy is missed, member 1's copy matched


def test_direct_wins_but_alternate_rows_multiply(spark):
    mem = members(spark, [(5, "C5", None)])
    alt = alt_ids(spark, [(6, "C5"), (7, "C5")])
    out = _run(spark, [pos_line(hd_loyalty_id="C5")], [], mem=mem, alt=alt)
    assert out.count() == 2
    # both copies carry the direct member; a transaction for member 5 covers both
    assert _run(spark, [pos_line(hd_loyalty_id="C5")], [txn_row(memberid=5)], mem=mem, alt=alt).count() == 0
    assert _run(spark, [pos_line(hd_loyalty_id="C5")], [txn_row(memberid=6)], mem=mem, alt=alt).count() == 2


def test_amount_compares_as_float32(spark):
    assert _run(spark, [pos_line(itm_amt_after_disc="12.1")], [txn_row(monetaryamount=12.1)]).count() == 0
    # beyond 2^24 distinct amounts collide in 32 bits, as in the source system
    assert _run(spark, [pos_line(itm_amt_after_disc="16777217")],
                [txn_row(monetaryamount=16777216.0)]).count() == 0


def test_tran_id_without_hash_is_its_own_kind(spark):
    assert _run(spark, [pos_line(hd_order_or_tran_id="SALE")], [], kind="SALE").count() == 1
    assert _run(spark, [pos_line(hd_order_or_tran_id="SALEX#1")], []).count() == 0


def test_sale_needs_purchase_type(spark):
    assert _run(spark, [pos_line()], [txn_row(type="RETURN")]).count() == 1


def test_return_header_match_takes_any_type(spark):
    line = pos_line(hd_order_or_tran_id="RETU#1-1", hd_orig_tran_id="SALE#1-1")
    assert _run(spark, [line], [txn_row(referencenumber="RETU#1-1", type="ANYTHING")]).count() == 0


def test_return_settled_by_return_on_original_tran(spark):
    line = pos_line(hd_order_or_tran_id="RETU#1-1", hd_orig_tran_id="SALE#9-9", hd_store_id="S2")
    # original-tran match ignores store, amount and item
    assert _run(spark, [line], [txn_row(referencenumber="SALE#9-9", type="RETURN", store="S7")]).count() == 0
    assert _run(spark, [line], [txn_row(referencenumber="SALE#9-9", type="VOID_RETURN")]).count() == 1
    assert _run(spark, [line], [txn_row(memberid=2, referencenumber="SALE#9-9", type="RETURN")]).count() == 1


def test_void_settled_by_either_void_type(spark):
    line = pos_line(hd_order_or_tran_id="VOID#1-1", hd_orig_tran_id="SALE#9-9")
    for ty in ("VOID_PURCHASE", "VOID_RETURN"):
        assert _run(spark, [line], [txn_row(referencenumber="SALE#9-9", type=ty)]).count() == 0
    assert _run(spark, [line], [txn_row(referencenumber="SALE#9-9", type="RETURN")]).count() == 1


def test_sale_has_no_original_tran_check(spark):
    line = pos_line(hd_orig_tran_id="SALE#9-9")
    assert _run(spark, [line], [txn_row(referencenumber="SALE#9-9", type="RETURN")]).count() == 1


def test_history_lines_are_not_reconciled_again(spark):
    assert _run(spark, [pos_line()], [], history=[pos_line()]).count() == 0


def test_batch_difference_is_null_safe_and_distinct(spark):
    a = pos_line(hd_store_id=None)
    b = lines_df(spark, [a, a, pos_line(hd_store_id="S9")])
    h = lines_df(spark, [a])
    out = new_lines(b, h).collect()
    assert len(out) == 1 and out[0]["hd_store_id"] == "S9"


def test_repeated_transactions_of_one_header_settle_by_any_of_their_types(spark):
    sale, ret = pos_line(), pos_line(hd_order_or_tran_id="RETU#2-1")
    rows = [txn_row(type=t) for t in (None, "RETURN", "PURCHASE", "PURCHASE")] + [txn_row(type=None, referencenumber="RETU#2-1")] * 3
    assert _run(spark, [sale, ret], rows).count() == 0
    assert _run(spark, [sale, ret], rows[:2] + rows[4:]).count() == 1   # no purchase: the sale is missed


@pytest.mark.parametrize("missed,threshold,passed", [(4, 5, True), (5, 5, False), (6, 5, False), (0, 5, True)])
def test_gate_is_strict(spark, missed, threshold, passed):
    rows = [pos_line(hd_order_or_tran_id=f"SALE#{i}-1") for i in range(missed)]
    m = _run(spark, rows, []) if rows else _run(spark, [pos_line()], [txn_row()])
    g = gate(m, threshold).first()
    assert g["missed"] == missed and g["passed"] is passed and g["non_empty"] is (missed > 0)
