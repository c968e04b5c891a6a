"""Small hand-made inputs for semantic tests."""

import datetime as dt


from tallyspark import schemas as S


def pos_line(**kw):
    base = {c: None for c in S.POS_COLUMNS}
    base.update({
        "hd_file_extract_date_time": "2024-02-01 00:00:00",
        "hd_order_or_tran_id": "SALE#1-1",
        "hd_order_date_time": "2024-01-31 10:00:00",
        "hd_loyalty_id": "C1",
        "hd_store_id": "S1",
        "hd_currency": "EUR",
        "itm_sku": "100",
        "itm_quantity": "1",
        "itm_amt_after_disc": "12.10",
        "country": "BEL",
        "hd_orig_tran_id": None,
    })
    base.update(kw)
    return base


def lines_df(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in S.POS_COLUMNS) for r in rows], S.POS_SCHEMA)


def txn_row(**kw):
    base = {c: None for c in S.LOYALTY_TXN_COLUMNS}
    base.update({"memberid": 1, "country": "BE", "referencenumber": "SALE#1-1",
                 "date": dt.datetime(2024, 1, 31, 10, 0), "store": "S1", "monetaryamount": 12.1,
                 "currency": "EUR", "type": "PURCHASE"})
    base.update(kw)
    return base


def txn_df(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in S.LOYALTY_TXN_COLUMNS) for r in rows],
                                 S.LOYALTY_TXN_SCHEMA)


def members(spark, rows):
    return spark.createDataFrame([(i, c, e, None, None) for i, c, e in rows], S.MEMBER_SCHEMA)


def alt_ids(spark, rows):
    return spark.createDataFrame(rows, S.MEMBER_ALT_ID_SCHEMA)


EMPTY_ALT = []
