"""Language identification, conversation repair and ns-bounds clustering against brute-force versions on small rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from tallyspark.llm import langid, ns_clusters, queries, repair

_random = np.random.default_rng(12)
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


# -- conversation repair --------------------------------------------------------------------------------------------


def hurt(rows):
    """The damaged rows of [(conv_id, turn, role, text)], in the order of conversation, turn (null first), role and MD5."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of a conversation's damaged rows."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        visible = VISIBLE.findall(text)
        faults.append("b" if not visible else "d" if (role, text) in seen else "" if visible[-1] in ".!?" else "t")
        seen.add((role, text))
    turns = {t for _, t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))

    def said_then(said, initial):
        """What the initials come to, with all but the last pair left out; None if no legal sequence begins so."""
        said += initial
        return said if re.fullmatch("s?(ua)?u?", said) else said[:-2] if re.fullmatch("s?uaua", said) else said[:-2] if re.fullmatch("s?uauau", said) else None

    # cheapest (cost, audit, rows) by number of rows read and by what was said, better ones put in until none is found
    best = {(0, ""): (0, "", ())}
    for i in range(len(rows) + 1):
        open_ = [k for k in best if k[0] == i]
        while open_:
            at = open_.pop()
            cost, audit, kept = best[at]
            steps = [(5, "I", at[0], n, ((n, ""),)) for n in ("user", "assistant")]
            if i < len(rows):
                _, _, role, text = rows[i]
                steps.append((2, "D", i + 1, None, ()))
                if faults[i] not in ("b", "d"):
                    more = 5 * (faults[i] == "t")
                    steps += [(price + more, letter, i + 1, n, ((n, text),)) for price, letter, n in ((0, "K", role), (1, "R", "user"), (1, "R", "assistant")) if n]
            for price, letter, j, name, new in steps:
                said = at[1] if name is None else said_then(at[1], name[0])
                if said is not None:
                    option = (cost + price, audit + letter, kept + new)
                    if (j, said) not in best or option[:2] < best[j, said][:2]:
                        best[j, said] = option
                        if j == i:
                            open_.append((j, said))
        if i < len(rows):
            best = {k: v for k, v in best.items() if k[0] > i}
    cost, audit, kept = min((v for (_, said), v in best.items() if re.fullmatch("(s?(ua)+)?", said)), key=lambda v: v[:2])
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check_repairs(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit("clash")).withColumn("gone", F.lit("x")).repartition(3)
    turns = repair.damage(frame)
    plans = repair.plan_repairs(turns)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.digests(turns, plans).collect()}
    got = {r["conv_id"]: (*(r[c] for c in COLUMNS[:-1]), digests[r["conv_id"]]) for r in plans.collect()}
    convs = {r[0] for r in rows}
    assert set(got) == convs and plans.count() == len(convs) == len(digests)
    for conv in convs:
        assert got[conv] == brute(hurt([r for r in rows if r[0] == conv])), conv
    return turns, plans


def test_repairs_equal_brute_force(spark):
    said = ["Fine.", "Well?", "cut off", "", " \t\n", "Same.", "é", "Ends with space. \n"]
    rows = []
    for conv in range(120):
        for turn in range(int(_random.integers(0, 9))):
            role = ["user", "assistant", "system", "tool", None, ""][int(_random.choice(6, p=[0.42, 0.4, 0.08, 0.04, 0.03, 0.03]))]
            text = [*said, None, f"Own {conv} {turn}.", f"More {turn}!"][int(_random.choice(11, p=[0.05] * 8 + [0.02, 0.3, 0.28]))]
            rows.append((conv, None if _random.random() < 0.04 else turn + int(_random.integers(3)) * (turn > 3), role, text))
    rows += [(None, 1, "user", "Null one."), (None, 2, "assistant", "Null two."), (500, None, "user", "A."), (501, 3, "user", "Twice."), (501, 3, "user", "Twice."), (501, 4, "assistant", "B.")]
    rows += [(600, t, "assistant" if t % 2 else "user", f"Turn {t}.") for t in range(-300, 300)]  # a long one
    rows += [(700 + i, t, ["user", "assistant"][t % 2], "x" * 3000 + f"{t}.") for i in range(3) for t in range(4)]
    turns, plans = check_repairs(spark, rows)
    # the repaired rows themselves, in place
    made = repair.repaired(turns, plans).collect()
    text = {}
    for r in sorted(made, key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["place"])):
        text.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.digests(turns, plans).collect()}
    assert all(digests[c] == hashlib.sha256("\n".join(text.get(c, [])).encode()).hexdigest() for c in digests)
    empty = turns.limit(0)
    assert repair.plan_repairs(empty).count() == 0 and repair.digests(empty, repair.plan_repairs(empty)).count() == 0


def test_a_node_is_made_once_for_all_signatures_with_its_ending():
    ending = bytes([6 * 4 % 16, 5, 9, 4, 8] * 4)
    fronts = [bytes([4, 8]), bytes([4, 8, 4, 9]), bytes([4, 8, 5, 8, 14])]
    nodes = repair.Nodes()
    for back in sorted((f + ending)[::-1] for f in fronts):
        nodes.reach(back)
    together = nodes.made
    shared = {(f + ending)[::-1][:i] for f in fronts for i in range(1, len(f) + len(ending) + 1)}
    assert together == len(shared) < sum(len(f) + len(ending) for f in fronts)


def test_registered_repair_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op12_dawg_repair(spark, SF_CHECK).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        assert got[conv] == brute(hurt([r for r in rows if r[0] == conv]))


# -- ns-bounds clustering -------------------------------------------------------------------------------------------


def lloyd(vectors, ids, k=ns_clusters.CLUSTERS, rounds=ns_clusters.ROUNDS, seed=ns_clusters.SEED):
    """Every vector measured against every centroid in every round, with Python's own integers."""
    code = lambda i: "~" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    start = sorted(range(len(ids)), key=lambda r: (code(ids[r]), vectors[r]))[:k]
    centroids = [list(vectors[r]) for r in start]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        own = [min(range(len(centroids)), key=lambda j: (square(v, centroids[j]), j)) for v in vectors]
        if turn < rounds:
            for j in range(len(centroids)):
                members = [v for v, o in zip(vectors, own, strict=True) if o == j]
                if members:
                    centroids[j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    far = [square(v, centroids[o]) for v, o in zip(vectors, own, strict=True)]
    return own, far, centroids


def as_integers(v):
    return [int(np.floor(64 * np.float64(np.float32(x)))) for x in v]


@pytest.mark.parametrize("clustered", [False, True])
def test_clusters_equal_brute_force(spark, clustered):
    n = 260
    x = _random.normal(size=(n, 64))
    if clustered:
        x = _random.normal(size=(9, 64))[_random.integers(9, size=n)] * 3 + x * 0.1
    x[40:70] = x[40]  # ties and repeated vectors
    ids = [int(i) for i in range(n)]
    ids[7], ids[8] = 6, None  # a repeated and a null id
    rows = [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]
    odd = [(900, None), (901, [1.0] * 63), (902, [float("nan")] * 64), (903, [float("inf")] + [0.0] * 63), (904, [None] + [0.0] * 63), (905, [])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("clash")).withColumn("x", F.lit(1)).repartition(4)
    found, centroids, spent = ns_clusters.cluster(frame)
    vectors = [as_integers(v) for v in x]
    own, far, want = lloyd(vectors, ids)
    assert [list(map(int, c)) for c in centroids] == want
    key = lambda r: (str(r[0]), *r[1:])
    got = sorted(((r["vec_id"], r["cluster"], r["distance"], tuple(r["x"])) for r in found.collect()), key=key)
    assert got == sorted(zip(ids, own, far, map(tuple, vectors), strict=True), key=key)
    assert spent[0] == n * len(want) and (not clustered or sum(spent[1:]) < 0.5 * 3 * spent[0])  # the bounds spare work where there are clusters
    full = ns_clusters.with_inertia(found, centroids).collect()
    assert {r["inertia"] for r in full} == {sum(far)}
    assert all(r["cluster_inertia"] == sum(d for d, o in zip(far, own, strict=True) if o == r["cluster"]) for r in full)
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, want[r["cluster"]])).encode()).hexdigest() for r in full)


def test_few_no_and_too_large_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(i, [float(i)] * 64) for i in range(3)], schema)
    found, centroids, _ = ns_clusters.cluster(few)
    assert len(centroids) == 3 and {r["distance"] for r in found.collect()} == {0}
    none, centroids, spent = ns_clusters.cluster(few.limit(0))
    assert none.count() == 0 and len(centroids) == 0 and spent == [] and ns_clusters.with_inertia(none, centroids).count() == 0
    with pytest.raises(Exception, match="squared distances"):
        ns_clusters.cluster(spark.createDataFrame([(1, [3e7] * 64)], schema))


def test_registered_clusters_equal_their_sql(spark, duck_small):
    from harness import compare

    r = compare(queries.op13_ns_clusters(spark, SF_SMALL), duck_small, queries.ORACLE["op13_ns_clusters"])
    assert r["columns_match"] and r["rows_match"] and r["hash_match"], r


# -- language -------------------------------------------------------------------------------------------------------


SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["gré", "ñan", "que", "los"], "cc": ["sch", "ung", "ein", "über"], "dd": ["本", "日", "語", "です"]}


def words(lang, n, seed):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang], 1 + int(r.integers(4)))) for _ in range(n))


def test_languages_are_learnt_and_rejected(spark):
    rows = [(i, words(lang, 3 + i % 40, i), lang, "s", 1) for i, lang in ((i, "aabbccdd"[2 * (i % 4):2 * (i % 4) + 2]) for i in range(800))]
    odd = [(900, None), (901, ""), (902, " \n\t"), (903, "1234 !!"), (904, "½ ² _"), (905, "Ж"), (906, words("bb", 60_000, 1)), (907, "kálo " * 3), (908, "KALOMI tuka"), (None, "kalo")]
    rows += [(i, t, None, None, None) for i, t in odd] + [rows[3], (rows[5][0], "kalo lo", "aa", "s", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int").withColumn("ids", F.lit(1)).repartition(4)
    model = langid.fit(frame)
    assert model.languages == ["aa", "bb", "cc", "dd"] and 0 < model.least < 1
    got = langid.identify(frame, model).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 800]
    right = [r["lang_pred"] == "aabbccdd"[2 * (r["doc_id"] % 4):2 * (r["doc_id"] % 4) + 2] for r in held]
    assert len(held) > 100 and np.mean(right) >= 0.98
    for i in (900, 901, 902, 903, 904):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert by_id[905]["lang_pred"] != "und" and by_id[906]["lang_pred"] == "bb" and by_id[908]["lang_pred"] == "aa" and not by_id[908]["rejected"]
    # labels, source and doc_id are no inputs
    other = frame.select((F.col("doc_id") + 5000).alias("doc_id"), "text", F.lit("zz").alias("lang"))
    assert sorted((r["doc_id"] - 5000, r["score"]) for r in langid.identify(other, model).collect() if r["doc_id"]) == sorted((r["doc_id"], r["score"]) for r in got if r["doc_id"] is not None)
    assert langid.identify(frame.limit(0), model).count() == 0
    none = langid.fit(frame.limit(0))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(frame, none).collect()} == {("und", 0.0)}
    one = langid.fit(frame.where("lang = 'aa'"))
    assert {r["lang_pred"] for r in langid.identify(frame.where("doc_id < 900"), one).collect()} == {"aa"}


def test_scores_equal_the_average_of_the_embeddings():
    r = np.random.default_rng(1)
    model = langid.Model(["x", "y", "z"])
    model.bias = r.normal(size=3).astype(np.float32)
    texts = [words("bb", 50, 1), "", "a", words("cc", 400, 2) + " 123 " + words("dd", 9, 3)]
    code = [int(c) for c in langid._CODE]

    def buckets(text):
        out = []
        for w in re.findall("(?:[^\\W\\d_]|[̀-ͯ])+", text.lower()):
            padded = f" {w} ".encode()
            finish = lambda h: int(langid.mixed(np.array([h % 2**64], np.uint64))[0]) % langid.BUCKETS
            for n in range(1, langid.LONGEST + 1):
                for i in range(len(padded) - n + 1):
                    gram = padded[i:i + n]
                    if gram != b" ":
                        h = 0
                        for c in gram:
                            h = h * int(langid._STEP) + code[c]
                        out.append(finish(h + n))
            out.append(finish(sum(code[c] * (k + 3) for k, c in enumerate(w.encode())) * int(langid._STEP) + 77))
        return out

    def plain(text):
        b = buckets(text)
        mean = np.mean([model.table[i].astype(np.float64) for i in b], axis=0) if b else np.zeros(langid.WIDTH)
        return mean @ model.layer.astype(np.float64) + model.bias

    got = langid.logits_of(model.per_bucket(), model.bias.astype(np.float64), texts)
    # the space between two words ends one and begins the other: it is looked at once, as it is in one word
    for text, row in zip(texts, got, strict=True):
        ids, counts = langid.bag(text)
        assert sorted(buckets(text)) == sorted(np.repeat(ids, counts).tolist())
        assert np.allclose(row, plain(text))


def test_registered_languages_on_rows_held_out(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = queries.op11_language_id(spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.97
    trusted = [r for r in got if not r["rejected"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in trusted]) >= 0.985
