import hashlib
import random
import re

from tripweave.llm import exact


def brute(rows):
    groups = {}
    for k, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((k, t or ""))
    out = []
    for content, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(k, keep, len(members), hashlib.sha256(content.encode()).hexdigest()) for k, _ in members]
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(1)
    base = ["", "a b", "ab", "é", " \n", "long " * 50, *(str(i) * rng.randint(1, 40) for i in range(40))]
    rows = [(i, rng.choice(base).replace(" ", rng.choice([" ", "\t", "  "]))) for i in range(400)]
    return [*rows, (1000, None), (None, "only"), (None, "a b    ")]


def test_against_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for budget in (exact.TABLE_BYTES, 300):  # the second one spills, again and again
        got = exact.exact_dedup(table, budget=budget).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got), key=repr) == brute(rows)
        assert sum(r.kept for r in got) == len({x[3] for x in brute(rows)})


def classes(rows, budget):
    return sorted(exact.grace_classes(((d, c, m, (m,), 1) for d, c, m in rows), budget))


def test_the_table_compares_contents(monkeypatch):
    same = b"\x01" * 32
    rows = [(same, b"one", 1), (same, b"two", 2), (same, b"one", 3)]
    assert classes(rows, 10**6) == [(1, (1,), 2), (2, (2,), 1), (3, (1,), 2)]
    expected = sorted([(1, (1,), 80), (2, (2,), 40), (3, (1,), 80)] * 40)
    assert classes(rows * 40, 1) == expected
    monkeypatch.setattr(exact, "MEMBERS", 7)  # members wait in the file
    assert classes(rows * 40, 1) == classes(rows * 40, 10**6) == expected


def test_ids_of_other_types(spark):
    rows = [(7, "a b"), (3, "ab "), (None, "c")]
    for kind in ("smallint", "string", "decimal(10,0)"):
        table = spark.createDataFrame(rows, "doc_id int, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text")
        got = {(r.doc_id and int(r.doc_id)): (r.keep_id and int(r.keep_id), r.group_size) for r in exact.exact_dedup(table).collect()}
        assert got == {7: (3, 2), 3: (3, 2), None: (None, 1)}


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(1, "x", "a", 0), (1, "x", "a", 0), (2, "x ", "b", 1), (3, None, "c", 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, row_0 int")
    kept = exact.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(map(tuple, kept.collect())) == [(2, "x ", "b", 1), (3, None, "c", 2)]
    assert exact.keep_one(table.limit(0)).count() == 0
