"""The operators of this package as queries over the test tables, and their SQL.

Each query reads its whole table and derives the columns of its contract from
what the operator returns.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import context_tree, quality, secrets, spelling, toxicity
from tallymart.llm.byte_dedup import byte_dedup
from tallymart.llm.decontaminate import benchmark_hits, contamination
from tallymart.llm.line_dedup import line_dedup
from tallymart.llm.packing import packed
from tallymart.llm.sharding import sharded
from tallymart.llm.simhash import fingerprints, near_duplicates
from tallymart.llm.store import stored, table
from tallymart.llm.substring_dedup import substring_dedup
from tallymart.llm.vector_codes import vector_codes


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    model = toxicity.train(docs, labels, ("low_quality", "toxic"))
    found = toxicity.scored(docs, model)
    p = F.col("probabilities")
    return found.select(
        "row.doc_id", F.round(p[0], 6).alias("p_low_quality"), F.round(p[1], 6).alias("p_toxic"),
        (p[1] >= model.thresholds[1]).alias("toxic"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", F.col("n_units").alias("n_lines"), "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(benchmark_hits(docs, table(spark, sf_dir, "benchmark")))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = [e.rule for e in quality.estimates(docs, quality.MORE)]
    measured = docs.select("doc_id", quality.measures().alias("m"), "text").select("doc_id", "m.*", "text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = measured.withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(quality.kept(order))
    return judged.withColumn("kept", kept).drop("text")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", F.col("n_units").alias("n_words"), "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharded(table(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return found.select(
        "row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.secret_spans(docs, secrets.train(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    base = listed(F.filter("spans", lambda s: s["kind"] != "markov"))
    return found.select(
        "row.doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select(
        "row.doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.vocabulary(docs, alter_one_in=199), factor=5)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    held_out = (F.crc32(id_text) % 7 == 2).alias("held_out")
    found = context_tree.scored(docs.select("doc_id", "text", held_out), ~held_out)
    bits = -F.col("score") / (F.col("n_bytes") + 1) / math.log10(2)
    return found.select(
        "row.doc_id", "row.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        bits.alias("bits_per_byte"),
    )


def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    hexes = F.transform("code", lambda x: F.lower(F.lpad(F.hex(x.cast("long")), 2, "0")))
    found = stored(codes.found.select("row.*", F.array_join(hexes, "").alias("code"), "error"), "codes")
    sums = found.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error"))
    digest = F.sha2(F.lit(codes.listing()).cast("binary"), 256)
    return found.join(sums, F.col("label").eqNullSafe(F.col("own")), "left").select(
        "vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_line_dedup, op3_benchmark_decontamination, op4_quality_rules, op5_suffix_array_dedup,
        op6_substring_dedup, op7_sharding, op8_packing, op9_secret_scans, op10_simhash_near_dedup,
        op11_spelling_variants, op12_lm_scoring, op13_vector_code_compression,
    )
}

def _codebook_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Plain rounds of assigning and averaging, one pair of queries for each."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
            SELECT * FROM (
                SELECT p.k, p.part, p.v, e.entry, list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - e.c[i]) * (p.v[i] - e.c[i]))) AS far
                FROM p JOIN e{r} e USING (part))
            QUALIFY row_number() OVER (PARTITION BY k, part ORDER BY far, entry) = 1
        )""")
        if r < rounds:
            steps.append(f"""s{r} AS (
            SELECT part, entry, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
            FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY part, entry, i
        ), m{r} AS (
            SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY part, entry
        ), e{r + 1} AS (
            SELECT e.part, e.entry, coalesce(m.c, e.c) AS c FROM e{r} e LEFT JOIN m{r} m USING (part, entry)
        )""")
    return f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS k, vec_id, label,
                list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS (
            SELECT k, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS v
            FROM (SELECT k, v, unnest(range({parts})) AS part FROM kept)
        ), e0 AS (
            SELECT part, k - 1 AS entry, v AS c FROM p WHERE k <= {entries}
        ), {", ".join(steps)}, c AS (
            SELECT k, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
            FROM a{rounds} GROUP BY k
        ), d AS (
            SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e{rounds}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM kept JOIN c USING (k) CROSS JOIN d
    """


_WORD = "'[^\\x20\\x09-\\x0D]+'"

ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": """
        WITH low AS (
            SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
            UNION ALL
            SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
        ), w AS (
            SELECT kind, id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM low
        ), items AS (
            SELECT id AS item_id, len(ws) AS n, least(13, len(ws)) AS size, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p, ws
            FROM w WHERE kind = 'b' AND len(ws) > 0
        ), pats AS (
            SELECT DISTINCT item_id, size, array_to_string(ws[p:p + size - 1], ' ') AS pat FROM items
        ), docwords AS (
            SELECT id AS doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w WHERE kind = 'd'
        ), hits AS (
            SELECT DISTINCT d.doc_id, d.p, s.size, pats.item_id
            FROM docwords d JOIN (SELECT DISTINCT size FROM pats) s ON d.p + s.size - 1 <= len(d.ws)
            JOIN pats ON pats.size = s.size AND pats.pat = array_to_string(d.ws[d.p:d.p + s.size - 1], ' ')
        ), hit AS (
            SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
                SELECT doc_id, unnest(range(p, p + size)) AS q FROM (SELECT DISTINCT doc_id, p, size FROM hits)) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
            FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
        )
        SELECT w.id AS doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.ws) AS contaminated
        FROM w LEFT JOIN hit ON hit.doc_id = w.id LEFT JOIN named ON named.doc_id = w.id WHERE w.kind = 'd'
    """,
    "op4_quality_rules": f"""
        WITH w AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents
        ), g AS (
            SELECT doc_id, p, array_to_string(ws[p:p + 4], ' ') AS gram
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS p FROM w)
        ), r AS (
            SELECT doc_id, count(DISTINCT q) AS n FROM (
                SELECT doc_id, unnest(range(p, p + 5)) AS q FROM (
                    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1) GROUP BY doc_id
        ), m AS (
            SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
                len(ls) AS n_lines, length(regexp_replace(t, '\\P{{Lu}}', '', 'g')) AS upper_chars,
                length(regexp_replace(t, '\\P{{Ll}}', '', 'g')) AS lower_chars, length(regexp_replace(t, '[^!]', '', 'g')) AS marks
            FROM w LEFT JOIN r USING (doc_id)
        ), b AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT (base_failed OR 10 * n_symbols > n_words OR upper_chars > lower_chars OR 2 * marks > n_words
                OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines) AS kept
        FROM b
    """,
    "op6_substring_dedup": f"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents
        ), g AS (
            SELECT doc_id, p, md5(array_to_string(ws[p:p + 19], ' ')) AS h
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM w)
        ), later AS (
            SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS k FROM g) WHERE k > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM later
        ), sums AS (
            SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
        ), kept AS (
            SELECT e.doc_id, string_agg(word, ' ' ORDER BY q) AS t
            FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM w) e
            ANTI JOIN gone USING (doc_id, q) GROUP BY e.doc_id
        )
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op13_vector_code_compression": _codebook_sql(),
    "op11_spelling_variants": """
        WITH RECURSIVE t AS (
            SELECT list_transform(range(256), lambda b: list_reduce(range(8),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc
        ), runs AS (
            SELECT doc_id, run, count(*) AS n FROM (
                SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{C0}-\\x{FF}]+')),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
            WHERE length(run) >= 6 GROUP BY doc_id, run
        ), b AS (
            SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs
        ), h AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_transform(range(length(x) // 2), lambda i: CAST(instr('0123456789ABCDEF', x[2 * i + 1]) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 17 AS BIGINT)),
                lambda c, v: xor(c >> 8, t.crc[(xor(c, v) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS h
            FROM b CROSS JOIN t
        ), w AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM h)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), cut AS (
            SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
        ), one AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT cut.word, w.word, w.n FROM cut JOIN w ON cut.rest = w.word
            UNION SELECT w.word, cut.word, cut.n FROM cut JOIN w ON cut.rest = w.word
        ), best AS (
            SELECT word, count(*) AS n_near, max(near_n) AS form_n, arg_min(near, (-near_n, near)) AS form FROM one GROUP BY word
        ), judged AS (
            SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
                CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM w LEFT JOIN best USING (word)
        ), way AS (
            SELECT word, word AS root, form AS beyond FROM judged
            UNION ALL SELECT way.word, j.word, j.form FROM way JOIN judged j ON j.word = way.beyond
        )
        SELECT j.word, j.form, root, j.n, n_near, j.form_n FROM judged j JOIN way ON way.word = j.word AND way.beyond IS NULL
    """,
}
