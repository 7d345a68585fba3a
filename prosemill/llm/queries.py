"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, hmm, langid, license_scan, merkle, mixing, quality, simhash, url_filter
from .common import crc_mod, table

#: Where the public tokenizer files are installed.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Sources by the root of their own shares, which halves the lead of a hot one; languages and topics by shares.
TARGETS = {"source": 0.5, "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}, "topic": {"short": 1.0, "medium": 4.0, "long": 4.0, "licence": 0.5, "contact": 0.5, "table": 0.2}}


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled outcomes: the quality label of the id that the page has."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    out = url_filter.filter_urls(table(spark, sf_dir, "pages"), outcomes)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "labelled", F.round("posterior_mean", 6).alias("posterior_mean"), F.round("lower_bound", 6).alias("lower_bound"))


def licence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a directory per source and 64 ids, in it one per 16 ids; ids divisible by 16 are licence files."""
    i = F.col("doc_id")
    base = F.concat(F.coalesce("source", F.lit("none")), F.lit("/p"), F.floor(i / 64).cast("string"))
    path = F.when(i % 64 == 0, F.concat(base, F.lit("/LICENSE"))).when(i % 16 == 0, F.concat(base, F.lit("/d"), F.floor(i % 64 / 16).cast("string"), F.lit("/LICENSE.txt"))).otherwise(F.concat(base, F.lit("/d"), F.floor(i % 64 / 16).cast("string"), F.lit("/f"), i.cast("string"), F.lit(".txt")))
    return table(spark, sf_dir, "documents").select(i.alias("file_id"), path.alias("path"), "text")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(licence_files(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "path", "licence", "basis", F.round("cosine", 6).alias("cosine"), "licence_dir")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.topic_of(F.col("text")), TARGETS)
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "source", "lang", "topic", "n_tokens", F.round("chance", 9).alias("chance"), F.round("mix_weight", 9).alias("mix_weight"), F.round("margin_miss", 9).alias("margin_miss"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.fit(docs, F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(False))))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(crc_mod("id", 4) == 2, F.lit(True)).alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), F.coalesce(crc_mod("id", 4) != 2, F.lit(False)))
    out = quality.classify(docs, model)
    return out.select(F.col("id").alias("doc_id"), F.coalesce(crc_mod("id", 4) == 2, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def _chat_digests(chats: DataFrame) -> DataFrame:
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def parts(column: pa.ListArray) -> list[np.ndarray]:
        """The lists as pieces of the one array that holds them; no number becomes an object."""
        return np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            rows = []
            for text, *places in zip(batch.column("formatted").to_pylist(), *(parts(batch.column(c)) for c in ("token_starts", "token_ends", "loss_starts", "loss_ends")), strict=True):
                first, last, begin, end = places
                turns, some = chat.parsed(text), end > begin
                masked = "".join(chat.unescaped(text[a:b]) for a, b in zip(first[begin[some]].tolist(), last[end[some] - 1].tolist(), strict=True))
                rows.append((len(turns), sha("".join(f"{role}\n{said}\n" for role, said in turns)), len(masked), sha(masked), len(text)))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *map(pa.array, zip(*rows, strict=True))], names=names)

    return chats.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return _chat_digests(chat.format_chats(rows, TOKENIZER))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.with_next(table(spark, sf_dir, "documents"))
    rows = rows.select("id", "text", "next_text", merkle.edited(F.col("text"), F.col("next_text")).alias("edited"))
    names = ("text", "edited", "next_text")
    trees = rows.select("id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), *(merkle.tree(F.col(n)).alias(n) for n in names))
    parts = {f"{part}_{n}": f(F.col(n)) for n in names for part, f in (("root", merkle.root), ("leaves", merkle.leaves))}
    places = merkle.differing(F.col("text"), F.col("edited"))
    rows = trees.select("id", "n_chars", "edited_sha256", places.alias("places"), *(c.alias(name) for name, c in parts.items()))
    like = lambda other: merkle.likeness(F.col("root_text"), F.col("leaves_text"), F.col(f"root_{other}"), F.col(f"leaves_{other}"))
    first = F.array_min(F.col("places"))
    return rows.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.col("root_text").alias("fingerprint"), F.col("root_edited").alias("edited_fingerprint"), like("edited").alias("near_edited"), like("next_text").alias("near_next"),
                       F.size("places").cast("long").alias("n_places"), first["section"].cast("long").alias("first_section"), first["paragraph"].cast("long").alias("first_paragraph"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hmm.score(table(spark, sf_dir, "documents"), crc_mod("id", 10) == 0)
    return out.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_url_filters, op2_license_scans, op3_mixing, op4_benchmark_decontamination, op5_language_id, op6_quality_classifier, op7_chat_formatting, op8_document_fingerprints, op9_simhash_near_dedup, op10_hidden_markov_scores)}

UPPER, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _level(groups: str) -> str:
    """SQL scalar: the prior strength of a table (n, k)."""
    return f"""(SELECT 1 / rho - 1 FROM (SELECT greatest(0.001, least(0.9, coalesce(CASE WHEN below > 0 THEN (spread - pq * (m - 1)) / below END, 0.1))) AS rho
      FROM (SELECT m, pq, kk - 2 * p * k1 + p * p * n1 AS spread, pq * (n1 - n2 / n1 - (m - 1)) AS below FROM (SELECT *, p * (1 - p) AS pq FROM
      (SELECT sum(n) AS n1, sum(k) AS k1, sum(n * n) AS n2, count(*) AS m, sum(k * k / n) AS kk, (sum(k) + 1) / (sum(n) + 2) AS p FROM {groups}))))) """


_RULES = "CASE " + " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{host}{path}'" for _, host, path in sorted(url_filter.RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
) + " END"
_VERDICTS = "CASE rule " + " ".join(f"WHEN '{host}{path}' THEN '{verdict}'" for verdict, host, path in url_filter.RULES) + " ELSE CASE WHEN lower_bound >= 0.7 THEN 'allow' ELSE 'block' END END"

OP1 = f"""WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
 page AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{UPPER}', '{LOWER_CASE}') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
 named AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\\.$', '') AS name FROM page),
 split AS (SELECT name, string_split(name, '.') AS l, regexp_matches(name, '^[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}$') OR starts_with(name, '[') AS numeric FROM (SELECT DISTINCT name FROM named)),
 level AS (SELECT *, array_to_string(l[greatest(1, len(l) - 1):], '.') AS two, array_to_string(l[greatest(1, len(l) - 2):], '.') AS three FROM split),
 hosts AS (SELECT name, CASE WHEN numeric THEN name WHEN two IN {url_filter.SUFFIXES} THEN three ELSE two END AS domain, CASE WHEN numeric THEN name WHEN two IN {url_filter.SUFFIXES} THEN two ELSE l[-1] END AS suffix FROM level),
 labelled AS (SELECT name, count(*)::DOUBLE AS n, sum(quality)::DOUBLE AS k FROM named JOIN labels ON doc_id = page_id WHERE quality IN (0, 1) GROUP BY name),
 domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM labelled JOIN hosts USING (name) GROUP BY ALL),
 suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
 whole AS (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean FROM suffixes),
 count AS (SELECT h.name, coalesce(l.n, 0) AS n, coalesce(l.k, 0) AS k, coalesce(d.n, 0) AS dn, coalesce(d.k, 0) AS dk, coalesce(s.n, 0) AS sn, coalesce(s.k, 0) AS sk, {_level('suffixes')} AS s0, {_level('domains')} AS s1, {_level('labelled')} AS s2
   FROM hosts h LEFT JOIN labelled l USING (name) LEFT JOIN domains d USING (domain) LEFT JOIN suffixes s ON h.suffix = s.suffix),
 up AS (SELECT *, (dk - k + s1 * ((sk - dk + s0 * (SELECT mean FROM whole)) / (sn - dn + s0))) / (dn - n + s1) AS prior FROM count),
 post AS (SELECT *, (k + s2 * prior) / (n + s2) AS posterior_mean FROM up),
 bound AS (SELECT *, posterior_mean - 1.645 * sqrt(posterior_mean * (1 - posterior_mean) / (n + s2 + 1)) AS lower_bound FROM post),
 ruled AS (SELECT *, {_RULES} AS rule FROM named JOIN bound USING (name))
 SELECT page_id, host, path, rule, {_VERDICTS} AS verdict, n::BIGINT AS labelled, round(posterior_mean, 6) AS posterior_mean, round(lower_bound, 6) AS lower_bound FROM ruled"""

_TOKEN, _ANCHOR, _LICENCE_FILE = license_scan.TOKEN, license_scan.ANCHOR, license_scan.LICENCE_FILE
_TEMPLATES = ", ".join("('{}', {}, '{}')".format(name, i, text.replace("'", "''")) for name, texts in license_scan.TEMPLATES.items() for i, text in enumerate(texts))
OP2 = f"""WITH file AS (SELECT doc_id, text, base || CASE WHEN doc_id % 64 = 0 THEN '/LICENSE' WHEN doc_id % 16 = 0 THEN '/d' || (doc_id % 64 // 16) || '/LICENSE.txt' ELSE '/d' || (doc_id % 64 // 16) || '/f' || doc_id || '.txt' END AS path
   FROM (SELECT *, coalesce(source, 'none') || '/p' || (doc_id // 64) AS base FROM documents)),
 template AS (SELECT name, variant, token, count(*)::DOUBLE AS tf FROM (SELECT name, variant, unnest(regexp_extract_all(lower(said), '{_TOKEN}')) AS token FROM (VALUES {_TEMPLATES}) t(name, variant, said)) GROUP BY ALL),
 part AS (SELECT doc_id, 'l' || generate_subscripts(string_split(text, chr(10)), 1) AS unit, unnest(string_split(text, chr(10))) AS said FROM file UNION ALL
   SELECT * FROM (SELECT doc_id, 'b' || generate_subscripts(regexp_split_to_array(text, '\n[ \t]*\n'), 1) AS unit, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) AS said FROM file) WHERE contains(said, chr(10)) UNION ALL
   SELECT doc_id, 'w', text FROM file WHERE regexp_matches(path, '{_LICENCE_FILE}')),
 unit AS (SELECT * FROM part WHERE regexp_matches(said, '{_ANCHOR}')),
 token AS (SELECT doc_id, unit, token, count(*)::DOUBLE AS tf FROM (SELECT doc_id, unit, unnest(regexp_extract_all(lower(said), '{_TOKEN}')) AS token FROM unit) GROUP BY ALL),
 df AS (SELECT token, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{_TOKEN}'))) AS token FROM documents) GROUP BY token),
 vector AS (SELECT name, variant, token, tf * ln(1 + (SELECT count(*) FROM documents) / (1 + coalesce(df, 0))) AS tw FROM template LEFT JOIN df USING (token)),
 norm AS (SELECT name, variant, sqrt(sum(tw * tw)) AS norm FROM vector GROUP BY ALL),
 weight AS (SELECT doc_id, unit, token, tf * ln(1 + (SELECT count(*) FROM documents) / (1 + df)) AS w FROM token JOIN df USING (token)),
 length AS (SELECT doc_id, unit, sqrt(sum(w * w)) AS unit_norm FROM weight GROUP BY ALL),
 score AS (SELECT doc_id, name, round(sum(w * tw) / any_value(unit_norm * norm), 9) AS cosine FROM weight JOIN vector USING (token) JOIN length USING (doc_id, unit) JOIN norm USING (name, variant) GROUP BY doc_id, unit, name, variant),
 kept AS (SELECT doc_id, name AS licence, cosine FROM score WHERE cosine >= 0.6 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, name) = 1),
 placed AS (SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM file),
 of_dir AS (SELECT dir AS licence_dir, licence FROM placed JOIN kept USING (doc_id) WHERE regexp_matches(path, '{_LICENCE_FILE}') QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, path) = 1),
 near AS (SELECT dir, licence AS inherited, licence_dir FROM (SELECT DISTINCT dir FROM placed) p JOIN of_dir o ON p.dir = o.licence_dir OR starts_with(p.dir, o.licence_dir || '/') QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(licence_dir) DESC) = 1)
 SELECT doc_id, path, coalesce(licence, inherited) AS licence, CASE WHEN licence IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis, round(cosine, 6) AS cosine, CASE WHEN licence IS NULL AND inherited IS NOT NULL THEN licence_dir END AS licence_dir
 FROM placed LEFT JOIN kept USING (doc_id) LEFT JOIN near USING (dir)"""

_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
OP4 = f"""WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER_CASE}'), '{_WORD}') AS w FROM documents),
 item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER_CASE}'), '{_WORD}') AS w FROM benchmark),
 phrase AS (SELECT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM item WHERE len(w) > 0)),
 place AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM doc) JOIN (SELECT DISTINCT size FROM phrase) ON i + size - 1 <= len(w)),
 found AS (SELECT doc_id, i, size, item_id FROM place JOIN phrase USING (size, s)),
 hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
 items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM found) GROUP BY doc_id)
 SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


_LEAF = merkle.LEAF.replace("*+", "*")


def _tree(text: str) -> str:
    """SQL: list of sections, each a list of paragraphs {h, l}: node and leaf nodes."""
    node = f"lambda p: {{'h': sha256(array_to_string(list_transform(regexp_extract_all(p, '{_LEAF}'), lambda x: md5(x)), ',')), 'l': list_transform(regexp_extract_all(p, '{_LEAF}'), lambda x: md5(x))}}"
    return f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), {node}))"


def _root(tree: str) -> str:
    return f"sha256(array_to_string(list_transform({tree}, lambda s: sha256(array_to_string(list_transform(s, lambda p: p.h), ','))), ','))"


def _leaves(tree: str) -> str:
    return f"list_distinct(flatten(list_transform(flatten({tree}), lambda p: p.l)))"


def _like(other: str) -> str:
    return f"CASE WHEN r_text = r_{other} THEN 1.0::DOUBLE WHEN len(l_text) + len(l_{other}) = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(l_text, l_{other})) / (len(l_text) + len(l_{other})) END"


_PLACE = "SELECT doc_id, i, unnest(t[i]) AS p, generate_subscripts(t[i], 1) - 1 AS j FROM (SELECT doc_id, t_{0} AS t, unnest(range(1, len(t_{0}) + 1)) AS i FROM t)"
OP8 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
 n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next FROM d),
 e AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(next, 1, length(text) // 2) AS edited FROM n),
 t AS (SELECT *, {_tree('text')} AS t_text, {_tree('edited')} AS t_edited, {_tree('next')} AS t_next FROM e),
 r AS (SELECT *, {', '.join(f'{_root(f"t_{x}")} AS r_{x}, {_leaves(f"t_{x}")} AS l_{x}' for x in ('text', 'edited', 'next'))} FROM t),
 place AS (SELECT doc_id, i - 1 AS section, j AS paragraph FROM ({_PLACE.format('text')}) a FULL JOIN ({_PLACE.format('edited')}) b USING (doc_id, i, j) WHERE a.p.h IS DISTINCT FROM b.p.h),
 placed AS (SELECT doc_id, count(*) AS n_places, min({{'s': section, 'p': paragraph}}) AS f FROM place GROUP BY doc_id)
 SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, r_text AS fingerprint, r_edited AS edited_fingerprint, {_like('edited')} AS near_edited, {_like('next')} AS near_next,
   coalesce(n_places, 0) AS n_places, f.s::BIGINT AS first_section, f.p::BIGINT AS first_paragraph FROM r LEFT JOIN placed USING (doc_id)"""

SQL: dict[str, str] = {"op1_url_filters": OP1, "op2_license_scans": OP2, "op4_benchmark_decontamination": OP4, "op8_document_fingerprints": OP8}
