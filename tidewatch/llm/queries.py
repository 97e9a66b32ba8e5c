"""Each operator of this subpackage as a query over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    collocations,
    decontaminate,
    html_extract,
    jaccard_join,
    langid,
    licenses,
    mixing,
    neighbours,
    pii,
    secrets,
    token_align,
    token_counts,
    toxicity,
)
from tidewatch.llm.common import table
from tidewatch.llm.sample import fold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_extract.extract(table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    taken = (F.col("_mix.size") * F.col("_mix.copies")).alias("taken")
    return planned.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", taken)


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.find(F.col("text")).alias("s"))
    spans = F.col("s")
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.as_text(base), 256).alias("base_sha256"),
        pii.as_text(spans).alias("spans"),
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", held_out, toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.by_line(table(spark, sf_dir, "documents"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = langid.predict(F.col("text"), langid.fit(docs))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    found = docs.select("doc_id", held_out, predicted.alias("p"))
    return found.select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected"
    )


@query
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@query
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secrets.find(F.col("text")).alias("s"))
    spans = F.col("s")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[secrets.count_of(spans, kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
        secrets.as_text(spans).alias("spans"),
    )


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.compare(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in licenses.KNOWN)

    def canonical(column: str) -> str:
        copyright_line = r"(?m)^[ \t]*(?:copyright[ \t:]+(?:\(c\)|©|[0-9]{4})|\(c\)|©)[^\n]*$"
        sql = f"regexp_replace(lower(coalesce({column}, '')), '{copyright_line}', ' ', 'g')"
        sql = rf"trim(regexp_replace({sql}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
        for found, put in licenses.SPELLINGS:
            sql = f"replace({sql}, {quote(found)}, {quote(put)})"
        return f"sha256({sql})"

    return rf"""
    WITH known AS (
        SELECT {canonical("text")} AS digest, min(license_id) AS license_id
        FROM (VALUES {known}) AS k(license_id, text) GROUP BY 1
    ), lines AS (
        SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
    ), numbered AS (
        SELECT doc_id, unnest(parts) AS line_text, unnest(range(1, len(parts) + 1)) AS line
        FROM lines
    ), units AS (
        SELECT doc_id, 0 AS line, {canonical("text")} AS digest FROM documents
        UNION ALL
        SELECT doc_id, line, {canonical("line_text")} FROM numbered
        WHERE regexp_matches(line_text, '[\p{{L}}\p{{N}}]')
    )
    SELECT doc_id, CAST(line AS INTEGER) AS line, digest, license_id
    FROM units LEFT JOIN known USING (digest)
    WHERE line = 0 OR license_id IS NOT NULL"""


#: All pairs by brute force, then classes by reachability: for small tables only.
JACCARD_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM documents
), shingles AS (
    SELECT r, unnest(list_distinct(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g
    FROM words
), sizes AS (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
), pairs AS (
    SELECT a.r AS a, b.r AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.r <> b.r
    JOIN sizes x ON x.r = a.r JOIN sizes y ON y.r = b.r
    GROUP BY a.r, b.r
), links AS (
    SELECT a, b, c = n AND c = m AS copy FROM pairs WHERE 10 * c >= 8 * (n + m - c)
), reach AS (
    SELECT a AS r, b AS other FROM links
    UNION
    SELECT reach.r, links.b FROM reach JOIN links ON reach.other = links.a
), class AS (
    SELECT reach.r, min(words.doc_id) AS class_id
    FROM reach JOIN words ON words.r = reach.other GROUP BY reach.r
), counts AS (
    SELECT a AS r, count(*) AS n_links, 1 + count(*) FILTER (WHERE copy) AS n_copies
    FROM links GROUP BY a
)
SELECT doc_id, least(doc_id, coalesce(class_id, doc_id)) AS class_id,
       coalesce(n_links, 0) AS n_links, coalesce(n_copies, 1) AS n_copies
FROM words LEFT JOIN class USING (r) LEFT JOIN counts USING (r)"""

ORACLES = {
    "op6_jaccard_join": JACCARD_SQL,
    "op10_license_scan": _license_sql(),
    "op11_phrase_collocations": collocations.mine_sql(),
    "op12_secret_scan": secrets.scan_sql(),
}
