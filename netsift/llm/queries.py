"""Named queries of the text operators and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from netsift.llm import (
    fingerprints, htmltext, lexical, licenses, neardup, packing, periodic, secrets, substrings, subwords, toxicity, urls,
    vectors,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Rules of the URL filter, as the task gives them.
URL_RULES = {
    "com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block",
}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id) -> F.Column:
    """Whether a document belongs to the fold that is never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@query
def op2_url_reputation(spark, folder):
    """Rules and host reputation over all pages. A page's outcome is its document's, whose id ends the path."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = (
        table(spark, folder, "labels")
        .filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    )
    number = F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS bigint)")
    outcomes = pages.select("url", number.alias("doc_id")).join(labels, "doc_id").select("url", "bad")
    return urls.judge(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op3_harmonic_packing(spark, folder):
    """All documents in sequences of 1024 ids."""
    packed = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op4_toxicity(spark, folder):
    """Toxicity of all documents, learnt outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op5_fingerprints(spark, folder):
    """Fingerprints of all documents and of their edited texts."""
    found = fingerprints.edited_fingerprints(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.packed(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.packed(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query
def op9_licenses(spark, folder):
    """Licence notices and whole licence texts in all documents, within lines and over several lines."""
    return licenses.notices(table(spark, folder, "documents"), licenses.ALL_TEMPLATES)


ORACLE["op9_licenses"] = licenses.notices_sql(licenses.ALL_TEMPLATES)


@query
def op8_near_duplicates(spark, folder):
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query
def op1_substring_dedup(spark, folder):
    """Words of all documents that no earlier passage of 20 words repeats."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query
def op7_near_vectors(spark, folder):
    """Links and components of all embeddings."""
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query
def op6_secret_scan(spark, folder):
    """All candidates for secrets in all documents, and the forest's verdict."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(docs, *secrets.fitted(docs))
    return found.select("doc_id", F.explode("findings").alias("f")).select("doc_id", "f.*")


@query
def op10_sentencepiece(spark, folder):
    """All documents encoded and decoded again; ids_sha256 is over the ids in decimal, joined by one space."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = subwords.decode(subwords.encode(table(spark, folder, "documents"), path), path)
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; where the checksum h of the id ends in 0, the words repeat from some word on.

    With g = h div 10, word i >= a becomes word a + (i - a) % p, for a = g % n and p = 1 + (n - a) div (3 + g % 8).
    """
    found = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    w = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    found = found.withColumn("w", F.when(F.col("h") % 10 == 0, w)).withColumns(
        {"g": F.expr("h div 10"), "n": F.size("w").cast("bigint")}
    )
    found = found.withColumn("a", F.expr("g % nullif(n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(w, (x, i) -> IF(i < a, x, get(w, int(a + (i - a) % p)))), ' ')")
    return found.select("doc_id", F.when(F.size("w") > 0, again).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, folder):
    """Runs of all documents, and their words without the repeats."""
    found = periodic.periodic_runs(looped(table(spark, folder, "documents")))
    # Fractions are compared by cross products, so that the comparison is exact; of equal ones the first run stays.
    better = "r.length * coalesce(best.period, 1) > coalesce(best.length, 0) * r.period"
    best = F.expr(
        "aggregate(runs, cast(null AS struct<start: bigint, length: bigint, period: bigint>), "
        f"(best, r) -> IF(best IS NULL OR {better}, r, best))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_ranked_search(spark, folder):
    """The 50 best documents of all benchmark items."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_main_text(spark, folder):
    """Main text of all pages, with a classifier trained on pages of the same table."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages, htmltext.fit(pages))


# SQL twins. Words are cut as in the operators; the separators are space and 0x09 to 0x0D.

_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]'), lambda w: w <> '')"
_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(nodes: str, links: str) -> str:
    """CTEs ``reached`` and ``components`` (node, component) for links (a, b) in both directions."""
    return f"""
reached(node, root) AS (
  SELECT node, node FROM {nodes} UNION SELECT l.b, r.root FROM reached r JOIN {links} l ON l.a = r.node AND r.root < l.b
),
components AS (SELECT node, min(root) AS component FROM reached GROUP BY node)"""


ORACLE["op1_substring_dedup"] = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS content FROM starts),
later AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS place FROM windows
  ) WHERE place > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS at FROM later),
each AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS at, unnest(w) AS word FROM words),
kept AS (
  SELECT e.doc_id, count(*) AS n, coalesce(string_agg(e.word, ' ' ORDER BY e.at), '') AS content
  FROM each e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.at = e.at GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.content, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id"""

ORACLE["op11_periodic_runs"] = f"""
WITH crc AS (SELECT *, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)), lambda x, k: xor(x // 2, 3988292384 * (x % 2)))
  ), 4294967295) AS h FROM documents),
cut AS (SELECT doc_id, h, h // 10 AS g, {_WORDS} AS w FROM crc),
shaped AS (SELECT *, len(w)::BIGINT AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) END AS a FROM cut),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM shaped),
words AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
  list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM periods),
each AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM words),
equal AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM each x JOIN each y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
  WHERE 3 * (y.i - x.i) <= x.n
),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM islands GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, s, len, min(q) AS q FROM stretches WHERE len >= greatest(24, 3 * q) GROUP BY doc_id, s, len
),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(format('{{}},{{}},{{}}' || chr(10), s, len, q), '' ORDER BY s, q) AS content
  FROM runs GROUP BY doc_id
),
best AS (
  SELECT doc_id, s, len, q FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (o.len * r.q > r.len * o.q
      OR (o.len * r.q = r.len * o.q AND (o.s < r.s OR (o.s = r.s AND o.q < r.q))))
  )
),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS content FROM each e
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = e.doc_id AND e.i >= r.s + r.q AND e.i < r.s + r.len) GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.len::BIGINT AS length, b.q::BIGINT AS period,
  (1000 * b.len // b.q)::BIGINT AS exponent_milli, sha256(coalesce(l.content, '')) AS runs_sha256,
  sha256(coalesce(k.content, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id
LEFT JOIN kept k ON k.doc_id = d.doc_id"""

_TERMS = f"regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLE["op12_ranked_search"] = f"""
WITH each AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM each GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id),
whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM lengths),
norms AS (SELECT doc_id, 100 - 50 + ((50 * n * documents) // total) AS m FROM lengths, whole),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, whole GROUP BY term
),
scores AS (
  SELECT a.item_id, c.doc_id, sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * m.m)))::BIGINT AS score
  FROM asked a JOIN counted c ON c.term = a.term JOIN weights w ON w.term = a.term JOIN norms m ON m.doc_id = c.doc_id
  GROUP BY a.item_id, c.doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50"""

ORACLE["op8_near_duplicates"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", f"coalesce({_FOLD}, '')")} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS content FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.content = b.content AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)
),
nodes AS (SELECT doc_id AS node FROM documents),{_components("nodes", "links")}
SELECT c.node AS doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component AS component_id, c.node = c.component AS kept
FROM components c LEFT JOIN sizes s ON s.doc_id = c.node"""

ORACLE["op7_near_vectors"] = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
nodes AS (SELECT vec_id AS node FROM embeddings),{_components("nodes", "links")}
SELECT c.node AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component AS component_id, c.node = c.component AS kept
FROM components c LEFT JOIN counts n ON n.a = c.node"""


def _reputation_sql() -> str:
    limits = urls.Reputation()
    rules = sorted(URL_RULES, key=lambda r: (len(r), r), reverse=True)

    def fits(rule: str) -> str:
        host, _, start = rule.partition("/")
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{start}')"

    def strength(key: str) -> str:
        return f"""(SELECT CASE WHEN coalesce(m, 0) < 2 OR variance <= 0 THEN {limits.most_strength}::DOUBLE
    ELSE least(greatest(p * (1 - p) / variance - 1, {limits.least_strength}), {limits.most_strength}) END FROM (
    SELECT m, p, ((kk - n * p * p) - (m - 1) * p * (1 - p)) / (n - nn / n) AS variance FROM (
      SELECT count(*) AS m, sum(n) AS n, sum(n * n) AS nn, sum(k * k / n) AS kk, sum(k) / sum(n) AS p
      FROM (SELECT {key}, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY {key}) WHERE n > 0)))"""

    suffix = " ".join(f"WHEN host = '{s}' OR ends_with(host, '.{s}') THEN '{s}'" for s in limits.suffixes)
    return f"""
WITH cut AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
placed AS (SELECT page_id, url,
  translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
outcome AS (SELECT doc_id, max(CAST(quality = 0 OR toxic = 1 AS INTEGER)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (SELECT p.host, o.bad FROM placed p LEFT JOIN outcome o
  ON o.doc_id = TRY_CAST(regexp_extract(p.url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS BIGINT)),
counted AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k FROM judged WHERE host <> '' GROUP BY host),
suffixed AS (SELECT *, CASE {suffix} ELSE list_last(string_split(host, '.')) END AS suffix FROM counted),
hosts AS (SELECT *, array_to_string(string_split(host, '.')[greatest(len(string_split(host, '.')) - len(string_split(suffix, '.')), 1):], '.') AS domain
  FROM suffixed),
strengths AS (SELECT {strength("suffix")} AS s, {strength("domain")} AS d, {strength("host")} AS h,
  coalesce((SELECT sum(k) / sum(n) FROM hosts), 0) AS mean),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix, domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
priors AS (SELECT d.domain, (d.k + t.d * (x.k + t.s * t.mean) / (x.n + t.s)) / (d.n + t.d) AS prior
  FROM domains d JOIN suffixes x ON x.suffix = d.suffix, strengths t),
rates AS (SELECT c.host, (c.k + t.h * p.prior) / (c.n + t.h) AS rate, c.n + t.h AS size
  FROM hosts c JOIN priors p ON p.domain = c.domain, strengths t),
ruled AS (SELECT *, CASE {" ".join(f"WHEN {fits(r)} THEN '{r}'" for r in rules)} END AS rule FROM placed)
SELECT r.page_id, r.host, r.path, r.rule,
  CASE {" ".join(f"WHEN r.rule = '{r}' THEN '{v}'" for r, v in URL_RULES.items())}
    WHEN x.rate - {limits.bound} * sqrt(x.rate * (1 - x.rate) / (x.size + 1)) > {limits.bad_rate} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN rates x ON x.host = r.host"""


ORACLE["op2_url_reputation"] = _reputation_sql()
