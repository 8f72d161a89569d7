import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tripweave.llm import suffix_tree


def corpus(seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    phrase = "one two three four five".split()
    rows = []
    for k in range(200):
        own = [rng.choice(words) for _ in range(rng.randint(0, 20))]
        if rng.random() < 0.6:
            at = rng.randint(0, len(own))
            own[at:at] = phrase
        rows.append((k, rng.choice([" ", "\n"]).join(own).title()))
    return [*rows, (900, None), (901, ""), (None, "w1 one two unseen")]


def scored(spark, rows, **options):
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id: r for r in suffix_tree.score_texts(table, **options).collect()}


def test_base_and_gain(spark):
    rows = corpus()
    got = scored(spark, rows)
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 5 == 1
    counts = Counter()
    for k, t in rows:
        if not held(k):
            counts.update([*(t or "").encode().lower().split(), b""])
    total, kinds = sum(counts.values()), len(counts)
    for k, t in rows:
        words = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(k), len(words), sum(counts[w] > 0 for w in words), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score <= 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 10


def test_each_state_is_a_distribution(spark):
    rows = corpus(5)
    texts = spark.createDataFrame([(t or "",) for _, t in rows], "text string")
    counts = suffix_tree.word_counts(texts, "text")
    tokens, distinct = counts.selectExpr("sum(n)", "count(*)").first()
    tree = suffix_tree.grow(texts, counts, tokens, distinct)
    assert len(tree.levels) == 2 and len(tree.levels[0].contexts) and len(tree.levels[1].contexts)
    unknown = 0.5 / tree.norm
    rare = distinct - len(tree.words)
    for context in ([suffix_tree.START], [suffix_tree.START, tree.words[b"one"]], [tree.words[b"one"], tree.words[b"two"]]):
        symbols = np.array([*tree.words.values()])
        lead = [0] * (3 - len(context)) + context
        ids = np.array([[*lead, s] for s in [*symbols, 0]]).ravel()
        ratios = tree.ratios(ids).reshape(len(symbols) + 1, -1)[:, -1]
        known = (ratios[:-1] * tree.root(symbols)).sum()
        # words that are too rare for the tree share the ratio of the unknown word
        left = 1 - tree.root(symbols).sum()
        assert math.isclose(known + ratios[-1] * left, 1, rel_tol=1e-9), (context, rare, unknown)


def test_odd_input(spark):
    assert scored(spark, []) == {}
    same = [(3, "a b"), (3, "a b"), (1, None)]
    table = spark.createDataFrame(same, "doc_id long, text string")
    rows = suffix_tree.score_texts(table.withColumn("row", table.doc_id)).collect()
    assert len(rows) == 3 and len({r.score for r in rows if r.doc_id == 3}) == 1


def test_a_context_stays_however_many_tokens_there_are(spark):
    texts = spark.createDataFrame([(t or "",) for _, t in corpus(5)], "text string")
    counts = suffix_tree.word_counts(texts, "text")
    tree = suffix_tree.grow(texts, counts, 500_000_000, 42)
    assert b"one" in tree.words and len(tree.levels) and len(tree.levels[0].contexts)


def test_the_third_word_back_counts(spark):
    rows = [(k, f"{a} mm nn {b}") for k, (a, b) in enumerate([("xx", "yy"), ("uu", "vv")] * 20)]
    deep, flat = scored(spark, rows), scored(spark, rows, depth=2)
    assert all(deep[k].score > flat[k].score + 0.2 for k, _ in rows)


def test_scores_are_those_of_the_gathered_tree(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "AT_HAND", 20)  # most numbers are met in the join
    rows = corpus(9)
    got = scored(spark, rows, held_out=9)  # all learn
    texts = spark.createDataFrame([(t or "",) for _, t in rows], "text string")
    counts = suffix_tree.word_counts(texts, "text")
    tokens, distinct = counts.selectExpr("sum(n)", "count(*)").first()
    tree = suffix_tree.grow(texts, counts, tokens, distinct)
    for k, t in rows:
        ids = np.array([suffix_tree.START, *(tree.words.get(w, 0) for w in [*(t or "").encode().lower().split(), b""])])
        gain = np.log10(tree.ratios(ids)[1:]).sum()
        assert math.isclose(got[k].score - got[k].base_score, gain, rel_tol=1e-6, abs_tol=1e-9)


def brute_scores(rows, depth, least=2, strength=2.0):
    """The tree from its definition: plain dictionaries of tuples, one probability a token."""
    texts = {k: ["<s>", *(t or "").lower().split(), ""] for k, t in rows}
    n = Counter(w for t in texts.values() for w in t[1:])
    total, kinds = sum(n.values()), len(n)
    norm = total + 0.5 * (kinds + 1)
    root = lambda w: (n[w] + 0.5) / norm
    seqs = Counter(tuple(t[i : i + m]) for t in texts.values() for m in range(1, depth + 2) for i in range(len(t) - m + 1))
    often = {s: c for s, c in seqs.items() if c >= least}
    price = math.log(len([s for s in often if len(s) == 1]) + 2)
    kept = {}

    def prob(context, w):
        """By the longest kept suffix of the context."""
        while context and context not in kept:
            context = context[1:]
        if not context:
            return root(w)
        listed, part, size = kept[context]
        lower = prob(context[1:], w)
        return listed[w] / (size + strength) + part * lower if w in listed else part * lower

    for m in range(1, depth + 1):
        found = {}
        for s, c in often.items():
            if len(s) == m + 1 and s[:-1] in often and s[1:] in often:
                found.setdefault(s[:-1], {})[s[-1]] = c
        fresh = {}
        for context, listed in found.items():
            size, seen = often[context], sum(listed.values())
            e = {w: prob(context[1:], w) for w in listed}
            gain = sum(c * math.log(c / size / e[w]) for w, c in listed.items())
            if others := max(size - seen, 0):
                gain += others * math.log(others / size / max(1 - sum(e.values()), 1e-9))
            if gain > len(listed) * price + 0.5 * math.log(max(size, 2)):
                fresh[context] = (listed, (strength + size - seen) / (strength + size), size)
        kept.update(fresh)
    return {k: sum(math.log10(prob(tuple(t[max(0, i - depth) : i]), t[i])) for i in range(1, len(t))) for k, t in texts.items()}


def test_scores_are_those_of_the_definition(spark):
    for depth in (1, 3):
        rows = corpus(11)
        got = scored(spark, rows, held_out=9, depth=depth)  # all learn
        for k, score in brute_scores(rows, depth).items():
            assert math.isclose(got[k].score, score, rel_tol=1e-6), (depth, k)


def nodes(plan):
    yield plan
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    for k in range(plan.children().size()):
        yield from nodes(plan.children().apply(k))


def test_rows_of_the_meeting_do_not_grow_with_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "AT_HAND", 20)
    rows = corpus(3)
    expected = scored(spark, rows)
    monkeypatch.setattr(suffix_tree, "COUNTED_TOKENS", 64)
    monkeypatch.setattr(suffix_tree, "SCORED_TOKENS", 64, raising=False)
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    result = suffix_tree.score_texts(table)
    got = {r.doc_id: r for r in result.collect()}
    assert all(math.isclose(got[k].score, r.score, rel_tol=1e-9) for k, r in expected.items())
    found = [n for n in nodes(result._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "FlatMapCoGroupsInArrowExec"]
    made = found[0].metrics().apply("pythonNumRowsReceived").value()
    buckets = 2 ** suffix_tree.buckets(got[0].train_tokens, 64)
    assert len(found) == 1 and len(rows) < made <= len(rows) + buckets, (made, buckets)


def test_keys_are_those_of_the_words():
    texts = [b"Ab\tab \x1cAB\x0b\x0c", b"", b"  ", "é É".encode(), b"a" * 5000, b" " * 5000 + b"ab"]
    ids, number = suffix_tree.keyed(pa.array([b"ab", *texts]).slice(1))
    words = [(k, w) for k, t in enumerate(texts) for w in [None, *t.lower().split(), b""]]
    seen = {}
    assert number.tolist() == [k for k, _ in words]
    assert all(seen.setdefault(w, i) == i for (_, w), i in zip(words, ids.tolist(), strict=True))
    assert len(set(seen.values())) == len(seen)


def test_only_sequences_that_may_have_a_number_are_met(spark):
    """A continuation is met where its context is kept; all that have a number are met."""
    rows = corpus(9)
    texts = spark.createDataFrame([(t or "",) for _, t in rows], "text string")
    counts = suffix_tree.word_counts(texts, "text")
    tokens, distinct = counts.selectExpr("sum(n)", "count(*)").first()
    words = suffix_tree.stored(suffix_tree.keyed_counts(counts), "tree-words")
    grown = suffix_tree.levels(texts, words, tokens, distinct)
    kept, listed = ([level[k] for level in grown] for k in (0, 1))
    codes = lambda tables: {r.code % (1 << 64) for t in tables for r in suffix_tree.as_rows(t).collect()}
    contexts, more = codes(kept), codes(listed)
    filters = [suffix_tree.filter_of(tables[0].unionAll(tables[1]).unionAll(tables[2])) for tables in (kept, listed)]
    ids, _ = suffix_tree.keyed(pa.array([t or "" for _, t in rows]))
    met = []
    for size, (keys, asked) in enumerate(suffix_tree.met_sequences(ids, suffix_tree.DEPTH + 1, filters), 1):
        inside = list(suffix_tree.sequences(ids, size))[-1][1]
        own = np.array([k in contexts or k in more or size == 1 and k != suffix_tree.START_KEY for k in keys.tolist()])
        assert not (own & inside & ~asked).any() and not (asked & ~inside).any()
        met.append((asked.sum(), (own & inside).sum()))
    asked, own = map(sum, zip(*met, strict=True))
    assert contexts and more and asked <= 1.02 * own, (asked, own)
    # the continuation of a context that is not kept is not met, though the filter has it
    none = [np.zeros_like(filters[0]), filters[1]]
    assert [asked.any() for _, asked in suffix_tree.met_sequences(ids, 3, none)] == [True, False, False]


def test_without_contexts_the_score_is_the_base(spark):
    got = scored(spark, corpus(4), depth=0)
    assert all(math.isclose(r.score, r.base_score, rel_tol=1e-12) for r in got.values())


def test_a_key_passes_by_all_its_bits(spark):
    rng = np.random.default_rng(3)
    codes = np.sort(rng.integers(0, 1 << 64 - suffix_tree.REGION, 1500, dtype=np.uint64))  # all in one region
    blocks = suffix_tree.blocks_of(3, codes, np.ones(len(codes), np.int64), np.zeros(len(codes)))
    bits = suffix_tree.filter_of(spark.createDataFrame([(k, bytearray(b)) for k, b in blocks], suffix_tree.BLOCKS))
    every = np.ones(len(codes), bool)
    assert suffix_tree.passing(bits, codes, every).all()
    assert not suffix_tree.passing(bits, codes, ~every).any()
    # one bit for each key would let 9 % of others through
    others = rng.integers(0, 1 << 64 - suffix_tree.REGION, len(codes), dtype=np.uint64)
    assert suffix_tree.passing(bits, others, every).mean() < 0.05
