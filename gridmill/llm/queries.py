"""The operators over the given tables, one thin query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill.llm import bitslice, decontamination, extraction, language, lexical, licences, linededup, neardup, packing, periodic, quality, repeats, scoring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


#: All pairs that share a shingle, and all that is reachable: for small tables.
NEAR_COPIES_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
 n AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM d),
 x AS (SELECT doc_id, len(s) AS n, unnest(s) AS one FROM n),
 l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.one = b.one AND a.doc_id < b.doc_id
       GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
 e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
 reach AS (SELECT doc_id AS node, doc_id AS label FROM documents UNION SELECT e.b, r.label FROM reach r JOIN e ON e.a = r.node)
SELECT n.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN (SELECT node, min(label) AS component_id FROM reach GROUP BY node) c ON c.node = n.doc_id"""


@query("op4_neardup", NEAR_COPIES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_copies(table(spark, sf_dir, "documents"))


@query("op3_scoring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.scored(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op8_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


@query("op10_repeats")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.removed(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return rows.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                       repeats.as_text("kept").alias("text"))


LINE_RUNS_SQL = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
           FROM documents WHERE text IS NOT NULL),
 k AS (SELECT doc_id, no, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t,
              len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
 f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS i, sum(n) OVER (PARTITION BY doc_id ORDER BY no) AS upto
       FROM k WHERE n > 0),
 w AS (SELECT a.doc_id, a.no AS first, a.i, min(b.i) AS j, min(b.no) AS last FROM f a JOIN f b
       ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= 4 GROUP BY 1, 2, 3),
 c AS (SELECT w.doc_id, w.first, w.last, string_agg(f.t, chr(10) ORDER BY f.i) AS content
       FROM w JOIN f ON f.doc_id = w.doc_id AND f.i BETWEEN w.i AND w.j GROUP BY 1, 2, 3),
 o AS (SELECT content, doc_id AS od, first AS oa, last AS ob FROM c
       QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, first) = 1),
 r AS (SELECT doc_id, CASE WHEN doc_id = od THEN greatest(first, ob + 1) ELSE first END AS first, last
       FROM c JOIN o USING (content) WHERE doc_id <> od OR first <> oa),
 g AS (SELECT DISTINCT l.doc_id, l.no FROM l JOIN r ON r.doc_id = l.doc_id AND l.no BETWEEN r.first AND r.last),
 m AS (SELECT l.*, g.no IS NOT NULL AS gone FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.no = l.no),
 s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY no), false) AS opens FROM m),
 t AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') AS text, count(*) AS n_lines,
              count_if(gone) AS n_removed, count_if(opens) AS n_runs FROM s GROUP BY doc_id)
SELECT d.doc_id, t.text, coalesce(t.n_lines, 0) AS n_lines, CAST(coalesce(t.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(t.n_runs, 0) AS INTEGER) AS n_runs
FROM documents d LEFT JOIN t USING (doc_id)"""


@query("op5_linededup", LINE_RUNS_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.delete_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "text", "n_lines", "n_removed", F.size("runs").alias("n_runs"))


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_licences")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op13_periodic")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every tenth document, by a hash of its number, go round from one of its words on; then runs of all documents."""
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.size("words").cast("long"), F.floor(h / 10)
    p = 1 + F.floor((n - F.col("a")) / (3 + g % 8))
    cycle = F.transform(F.sequence("a", n - 1), lambda i: F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("words", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    docs = docs.withColumn("a", F.when(n > 0, g % n)).withColumn("p", p)
    docs = docs.withColumn("text", F.when(n > 0, F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), cycle), " ")).otherwise(F.col("text")))
    rows = periodic.periodic_runs(docs)
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return rows.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


PRODUCTS_SQL = r"""WITH v AS (SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
 x AS (SELECT row, vec_id, generate_subscripts(embedding, 1) AS d, unnest(embedding) AS c FROM v),
 g AS (SELECT row FROM x GROUP BY row HAVING count(c) < count(*) OR bool_or(NOT isfinite(c::DOUBLE))),
 i AS (SELECT row, vec_id, d, CAST(floor(64 * c::DOUBLE) AS BIGINT) AS c FROM x WHERE row NOT IN (SELECT row FROM g)),
 s AS (SELECT a.row, a.vec_id AS query_id, b.vec_id, CAST(sum(a.c * b.c) AS BIGINT) AS score
       FROM i a JOIN i b ON a.d = b.d AND a.row <> b.row WHERE a.vec_id % 20 = 0 GROUP BY a.row, a.vec_id, b.row, b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) <= 20"""


@query("op12_products", PRODUCTS_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_products(table(spark, sf_dir, "embeddings"), every=20, k=20)


RANKED_SQL = r"""WITH t AS (SELECT rowid AS row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
 f AS (SELECT row, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
 n AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY row),
 s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM n),
 w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM f, s GROUP BY term, docs),
 m AS (SELECT row, 100 - 90 + (90 * n * docs) // length AS m FROM n, s),
 i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
 r AS (SELECT item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
       FROM i JOIN f USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY item_id, doc_id, row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"""


@query("op11_search", RANKED_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lexical.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return rows.select("item_id", "rank", "doc_id", "score")
