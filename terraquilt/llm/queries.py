"""The registered queries of the text operators, over whole tables, with SQL where it can say the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraquilt.llm import (
    byte_cnn, conversation_repair, direct_codes, host_reputation, html_blocks, minhash, mixing, order_minhash, packing, quality_rules,
    sharding, toxicity, whitening,
)
from terraquilt.llm.common import table
from terraquilt.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Fixed values of the mix: weights of the sources in turn, share of all words, most epochs.
MIX = {"weights": (5.0, 2.0, 1.0), "share": 1.5, "max_epochs": 2.0}
#: Fixed rules for urls: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def _query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
#: All pairs that share a shingle, compared on full sets; reachability by recursion.
NEAR_SQL = f"""WITH RECURSIVE
    d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[\\x20\\x09-\\x0D]+'),
                                     lambda x: len(x) > 0) AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[r.i:r.i + 2], ' ') AS g
          FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS r(i) WHERE len(w) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    e AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    linked AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach AS r JOIN linked AS l ON r.b = l.a)
    SELECT a AS doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(b) AS component_id, a = min(b) AS kept
    FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a"""


@_query("op2_minhash_near_dedup", NEAR_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@_query("op3_mix_sources")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"), **MIX).select("doc_id", "size", "source_size", "target", "taken")


@_query("op4_rendezvous_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_layout(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@_query("op5_harmonic_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@_query("op6_order_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprint_edits(table(spark, sf_dir, "documents"))


@_query("op7_isolation_forest_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _level_sql(level: str, above: str) -> str:
    """Posteriors of one level: its groups' sums shrunk to the mean of the level above."""
    return f"""
    {level}_g AS (SELECT {level} AS k, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY 1),
    {level}_t AS (SELECT sum(bad) / sum(n) AS p FROM {level}_g WHERE n > 0),
    {level}_c AS (SELECT any_value(p) AS p, sum(n * pow(bad / n - p, 2)) AS s, count(*) - 1 AS f, sum(n) - sum(n * n) / sum(n) AS m
                  FROM {level}_g, {level}_t WHERE n > 0),
    {level}_s AS (SELECT 1 / least(greatest(CASE WHEN p * (1 - p) > 0 AND m > f THEN (s / (p * (1 - p)) - f) / (m - f) ELSE 0.001 END,
                                            0.001), 0.5) - 1 AS strength FROM {level}_c),
    {level}_p AS (SELECT h.host, g.bad + prior * strength AS a, g.n - g.bad + (1 - prior) * strength AS b
                  FROM h JOIN {level}_g AS g ON g.k = h.{level} JOIN {above}_q AS q ON q.host = h.host, {level}_s),
    {level}_q AS (SELECT host, a / (a + b) AS prior FROM {level}_p)"""


_TWO = ", ".join(f"'{x}'" for x in host_reputation.MORE_LABEL_SUFFIXES if x.count(".") == 1)
_RULES_BY_LENGTH = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))


def _rule_sql(shown: dict[str, str]) -> str:
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{shown[h + p]}'" for h, p, _ in _RULES_BY_LENGTH
    ) + " END"


URL_SQL = f"""WITH
    u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), {_LOWER}) AS host,
                 regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
    known AS (SELECT doc_id, max(CAST(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 AS INT)) AS bad FROM labels
              WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY 1),
    o AS (SELECT page_id, max(bad) AS bad FROM u JOIN known
          ON known.doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})(?:[.]html|/)?$', 1) AS BIGINT) GROUP BY 1),
    c AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM u LEFT JOIN o USING (page_id) GROUP BY 1),
    l AS (SELECT *, string_split(site, '.') AS w, array_to_string(string_split(site, '.')[-2:], '.') AS two,
                 regexp_matches(site, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$') OR starts_with(site, '[') AS address
          FROM (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS site FROM c)),
    h AS (SELECT host, n, bad,
                 CASE WHEN address THEN site WHEN two IN ({_TWO}) AND site <> two THEN two ELSE w[-1] END AS suffix,
                 CASE WHEN address THEN site WHEN two IN ({_TWO}) AND site <> two THEN array_to_string(w[-3:], '.') ELSE two END AS domain FROM l),
    all_q AS (SELECT host, (SELECT (sum(bad) + 0.5) / (sum(n) + 1) FROM h) AS prior FROM h),
    {_level_sql("suffix", "all")}, {_level_sql("domain", "suffix")}, {_level_sql("host", "domain")}
    SELECT page_id, host, path, {_rule_sql({h + p: h + p for h, p, _ in URL_RULES})} AS rule,
           coalesce({_rule_sql({h + p: v for h, p, v in URL_RULES})},
                    CASE WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 THEN 'block' ELSE 'allow' END)
           AS verdict
    FROM u JOIN host_p USING (host)"""


@_query("op10_host_reputation", URL_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = host_reputation.outcomes_from_labels(pages, table(spark, sf_dir, "labels"))
    return host_reputation.judge_urls(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@_query("op1_html_main_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract_main_text(table(spark, sf_dir, "pages"))


@_query("op8_byte_cnn_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = byte_cnn.training_fold("doc_id", 3, 1)
    net = byte_cnn.fit_quality(docs, labels, learn)
    return byte_cnn.add_quality(docs, net).select(
        "doc_id", (~learn).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@_query("op9_boosted_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = byte_cnn.training_fold("doc_id", 4, 2)
    model = toxicity.fit_toxicity(docs, labels, learn)
    return toxicity.add_toxicity(docs, model).select(
        "doc_id", (~learn).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@_query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    rows = whitening.whiten(vectors, whitening.fit_whitening(vectors))
    # a deviation beyond a long is NULL there, and whole in the column beside it
    return rows.select(
        "vec_id", "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "whitened", "explained",
        "identity_error", F.col("deviation").alias("deviation_digits"),
    )


@_query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_report(damaged, copies="copies")


@_query("op13_direct_token_codes")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-codes")
    direct_codes.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return direct_codes.read_documents(spark, path)
