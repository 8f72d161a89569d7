"""The driver's queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.llm import bisectors, bpe, chat, exact, lines, near, packing, replay, simhash, suffix_tree, suffixes, toxicity, whitening
from tripweave.llm.common import bucket_of, documents, stored


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], turns.schema)
    return chat.read_back(chat.format_turns(turns.unionByName(extra)))


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_texts(documents(spark, sf_dir, "doc_id", "text"))


def op3_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return toxicity.score(docs, model, keep=["doc_id"], column="score").select(
        "doc_id",
        (bucket_of("doc_id", toxicity.TRAINED) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_texts(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    return packing.with_crc32(pieces).select(*columns)


def op5_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coding_digest(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")


def op6_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near.near_dedup(documents(spark, sf_dir, "doc_id", "text"))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op7_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.exact_dedup(documents(spark, sf_dir, "doc_id", "text"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(simhash.edited_likeness(documents(spark, sf_dir, "doc_id", "text")), "simhash-rows")
    classes = simhash.near_classes(rows)
    return rows.join(classes, "print").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "near_class",
    )


def op9_radix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.remove_repeats(documents(spark, sf_dir, "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_line_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.line_dedup(documents(spark, sf_dir, "doc_id", "text"))
    return rows.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op11_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op12_bisector_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.coding_digest(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_string_kernel": op3_string_kernel,
    "op4_vector_packing": op4_vector_packing,
    "op5_tree_bpe": op5_tree_bpe,
    "op6_odd_sketches": op6_odd_sketches,
    "op7_grace_dedup": op7_grace_dedup,
    "op8_simhash": op8_simhash,
    "op9_radix_repeats": op9_radix_repeats,
    "op10_line_suffixes": op10_line_suffixes,
    "op11_polarised_whitening": op11_polarised_whitening,
    "op12_bisector_tournament": op12_bisector_tournament,
    "op13_merge_replay": op13_merge_replay,
}


def _clustering_sql(k: int, rounds: int, dimensions: int) -> str:
    """The rounds one after the other, over whole numbers that doubles hold exactly."""
    nearest = """
        {name} as materialized (
            select vec_id, any_value(v.x) as x,
                   min(((list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x))::hugeint * {k} + c.k)) as best
            from kept v cross join {centroids} c group by vec_id
        )"""
    mean = """
        {name} as materialized (
            select c.k, coalesce(m.x, c.x) as x from {old} c left join (
                select k, list(((s - ((s % n) + n) % n) // n)::double order by i) as x from (
                    select k, i, sum(value::hugeint)::hugeint as s, count(*)::hugeint as n from (
                        select (best % {k})::bigint as k, unnest(x) as value, generate_subscripts(x, 1) as i from {placed}
                    ) group by k, i
                ) group by k
            ) m using (k)
        )"""
    parts = [
        f"""
        kept as materialized (
            select vec_id, list_transform(embedding, lambda c: floor(c::double * 256)) as x from embeddings
            where len(embedding) = {dimensions} and len(list_filter(embedding, lambda c: isfinite(c))) = {dimensions}
        ), c0 as materialized (
            select row_number() over (order by sha256('2:' || vec_id)) - 1 as k, x
            from kept qualify row_number() over (order by sha256('2:' || vec_id)) <= {k}
        )"""
    ]
    for r in range(rounds):
        parts.append(nearest.format(name=f"p{r}", centroids=f"c{r}", k=k))
        parts.append(mean.format(name=f"c{r + 1}", old=f"c{r}", placed=f"p{r}", k=k))
    parts.append(nearest.format(name="last", centroids=f"c{rounds}", k=k))
    return (
        "with "
        + ", ".join(parts)
        + f""", done as (select vec_id, (best % {k})::int as cluster, (best // {k})::bigint as distance from last)
        select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
               (sum(distance) over ())::bigint as inertia,
               sha256(array_to_string(list_transform(x, lambda v: v::bigint), ',')) as centroid_sha256
        from done join c{rounds} c on c.k = done.cluster
    """
    )


ORACLES = {
    "op12_bisector_tournament": _clustering_sql(bisectors.CENTROIDS, bisectors.ROUNDS, bisectors.DIMENSIONS),
    "op10_line_suffixes": """
        with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
        window_ as (
            select doc_id, pos, list_slice(ls, pos + 1, pos + 3) as win
            from split, unnest(range(0, greatest(len(ls) - 2, 0))) as t(pos)
        ), first_ as (
            select doc_id, pos, first_value(doc_id) over w as fdoc, first_value(pos) over w as fpos
            from window_ window w as (partition by win order by doc_id, pos)
        ), later as (
            select *, pos - row_number() over (partition by doc_id, fdoc, pos - fpos order by pos) as island
            from first_ where not (doc_id = fdoc and pos = fpos)
        ), longest as (
            select doc_id, max(n) + 2 as longest_copy
            from (select doc_id, count(*) as n from later group by doc_id, fdoc, pos - fpos, island) group by doc_id
        ), gone as (select distinct doc_id, pos + k as i from later, unnest([0, 1, 2]) as t(k)),
        lines_ as (
            select s.doc_id, i, ls[i + 1] as line from split s, unnest(range(0, len(ls))) as t(i)
        ), marked as (
            select l.*, g.i is not null as dropped, lag(g.i is not null, 1, false) over (partition by l.doc_id order by l.i) as before
            from lines_ l left join gone g using (doc_id, i)
        )
        select m.doc_id, count(*) as n_lines, count(*) filter (dropped) as n_removed,
               count(*) filter (dropped and not before) as n_runs, coalesce(any_value(longest_copy), 0) as longest_copy,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) as kept_sha256
        from marked m left join longest using (doc_id) group by m.doc_id
    """,
    "op1_chat_format": """
        with rows_ as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
            union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'
        ), placed as (
            select *, row_number() over w as n, lag(role) over w as before,
                   regexp_replace(text, '(\\\\|###|</turn>|: )', '\\\\\\1', 'g') as escaped
            from rows_ window w as (partition by conv_id order by turn nulls first, role, text)
        ), judged as (
            select *, case coalesce(before, '') when '' then role in ('system', 'user') when 'system' then role = 'user'
                      when 'user' then role = 'assistant' when 'assistant' then role = 'user' else false end as allowed
            from placed
        )
        select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
               sum(length('### ' || role || ': ' || escaped || '</turn>' || chr(10)))::bigint as formatted_chars,
               bool_and(allowed) and arg_max(role, n) = 'assistant' as valid,
               min(n - 1) filter (not allowed) as first_error
        from judged group by conv_id
    """,
    "op7_grace_dedup": """
        with n as (select doc_id, coalesce(text, '') as t,
                          regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
               doc_id = first_value(doc_id) over w as kept, sha256(norm) as text_sha256
        from n window w as (partition by norm order by length(t) desc, doc_id)
    """,
}
