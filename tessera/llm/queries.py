"""Registered queries of the training-data operators (opN_<name>) and their SQL."""

from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup as ED
from . import merkle as MK
from . import odd_minhash as OM
from . import prefix_trie as PT
from . import quality_rules as QR
from . import quote_links as QL
from . import secret_forest as SF
from . import shard_mix as SM
from . import simhash_decontam as SH
from . import suffix_dedup as SD
from . import toxicity_ssk as TX
from . import trie_bpe as TB
from . import url_logit as UL
from .common import table

#: The public vocabulary file of the installed package (a parameter; never copied into the repository).
BPE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op8_odd_minhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of documents: 4-word shingles, similarity 0.8."""
    out = OM.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)
    return out.withColumnRenamed("id", "doc_id").select("doc_id", "n_shingles", "component_id", "kept")


@register("op6_trie_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded."""
    return TB.encode(table(spark, sf_dir, "documents"), BPE_VOCABULARY)


@register("op7_subsequence_svm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = TX.train(docs, table(spark, sf_dir, "labels").where(~TX.held_out()))
    return TX.score(docs, model).select("doc_id", TX.held_out().alias("held_out"), "score",
                                        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op4_stratified_interleave")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 7 that each match the mixture of sources."""
    return SM.interleave(table(spark, sf_dir, "documents"), shards=8)


#: The rules of the contract: verdict, host, path prefix.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@register("op10_url_logit")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url: the longest rule's, else the model's."""
    return UL.judge(table(spark, sf_dir, "pages"), URL_RULES, UL.train(spark)).withColumn(
        "block_probability", F.round("block_probability", 6))


@register("op1_suffix_merge")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of documents that repeat a 50-byte string of a document with a smaller id."""
    return SD.remove_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register("op9_simhash_windows")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold."""
    return SH.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op2_sql() -> str:
    """The counts, the exact binomial tests and the verdicts as DuckDB SQL."""
    tries = " UNION ALL ".join(
        f"SELECT stratum, '{rule}' AS rule, {float(c)!r}::DOUBLE AS cut, count(*) FILTER (good = 1) AS n1, count(*) FILTER (good = 0) AS n0, "
        f"count(*) FILTER (good = 1 AND v_{rule} > {float(c)!r}::DOUBLE) AS k1, count(*) FILTER (good = 0 AND v_{rule} > {float(c)!r}::DOUBLE) AS k0 "
        f"FROM held GROUP BY stratum" for rule, cuts in QR.CUTOFFS.items() for c in cuts)
    share = "CAST({} AS DOUBLE) / greatest({}, 1)"
    cut = ", ".join(f"max(b.cut) FILTER (b.rule = '{r}') AS cut_{r}" for r in QR.CUTOFFS)
    above = " OR ".join(f"coalesce(v_{r} > cut_{r}, false)" for r in QR.CUTOFFS)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
win AS (
  SELECT row, unnest(range(1, len(words) - 6)) AS i, unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS w FROM split),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w) AS n FROM win) t WHERE n > 1),
cover AS (
  SELECT row, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS nxt FROM twice) t GROUP BY row),
counted AS (
  SELECT s.row, doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN cover c ON c.row = s.row),
measured AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    {share.format('n_symbols', 'word_chars')} AS v_symbols, {share.format('word_chars', 'n_words')} AS v_word_length,
    {share.format('n_dup_lines', 'n_lines')} AS v_dup_lines, {share.format('n_repeat_words', 'n_words')} AS v_repeats,
    {share.format('n_capitals', 'word_chars')} AS v_capitals FROM counted),
held AS (
  SELECT m.*, good FROM measured m JOIN (SELECT DISTINCT doc_id, quality AS good FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1)) l
    ON l.doc_id = m.doc_id WHERE NOT base_failed),
tests AS ({tries}),
sure AS (
  SELECT stratum, rule, cut, CAST(k0 AS DOUBLE) / greatest(n0, 1) - CAST(k1 AS DOUBLE) / n1 AS gain FROM tests
  WHERE n1 > 0 AND k0 > 0 AND k1 < n1 * {QR.RISK!r}::DOUBLE AND list_sum(list_transform(range(0, k1 + 1), lambda i:
    exp(lgamma(n1 + 1.0) - lgamma(i + 1.0) - lgamma(n1 - i + 1.0) + i * ln({QR.RISK!r}::DOUBLE) + (n1 - i) * ln(1 - {QR.RISK!r}::DOUBLE))))
    <= {QR.ERROR!r}::DOUBLE / (SELECT greatest(1, count(*)) FROM tests)),
best AS (SELECT stratum, rule, max({{'gain': gain, 'cut': cut}}).cut AS cut FROM sure WHERE gain > 0 GROUP BY stratum, rule),
cuts AS (SELECT stratum, {cut} FROM best b GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({above}) AS kept,
  {", ".join(f"cut_{r}" for r in QR.CUTOFFS)}
FROM measured m LEFT JOIN cuts c ON c.stratum = m.stratum"""


@register("op2_risk_controlled_rules", _op2_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdicts of every whole text."""
    return QR.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_MARKS = r"^(?:[\x20\t]*>)+"
_INTRO = r"(?i)^.{0,200}\b(?:wrote|schrieb|escribi(?:ó|o)|a (?:é|e)crit)[\x20\t]*:[\x20\t]*$"
OP3_SQL = f"""
WITH RECURSIVE own AS (
  SELECT conv_id AS conv, turn, role, text, string_split(text, chr(10)) AS lines FROM conversations),
kept AS (
  SELECT conv, turn, role, text, list_filter(lines, lambda x, i: NOT regexp_matches(x, '{_MARKS}')
    AND NOT (regexp_matches(x, '{_INTRO}') AND i < len(lines) AND regexp_matches(lines[i + 1], '{_MARKS}'))) AS mine FROM own),
said AS (
  SELECT conv, turn, role, text, coalesce(array_to_string(mine, chr(10)), '') AS own_text FROM kept),
line AS (
  SELECT conv, turn, text, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
  FROM (SELECT DISTINCT conv, turn, text, lines FROM own WHERE conv IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL)),
leveled AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '{_MARKS}'), '[^>]', '', 'g')) AS level,
    lower(trim(regexp_replace(regexp_replace(line, '{_MARKS}', ''), '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm FROM line),
marked AS (
  SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY conv, turn, text ORDER BY pos) THEN 0 ELSE 1 END AS new FROM leveled),
passage AS (
  SELECT *, sum(new) OVER (PARTITION BY conv, turn, text ORDER BY pos) AS passage FROM marked),
quoted AS (SELECT * FROM passage WHERE level > 0 AND norm <> ''),
mine AS (
  SELECT conv, turn, unnest(string_split(own_text, chr(10))) AS line FROM said WHERE conv IS NOT NULL AND turn IS NOT NULL),
first AS (
  SELECT conv, norm, min(turn) AS source FROM (
    SELECT conv, turn, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm FROM mine) t
  WHERE norm <> '' GROUP BY ALL),
vote AS (
  SELECT q.conv, q.turn, q.text, q.passage, q.level, CASE WHEN f.source < q.turn THEN f.source END AS source, count(*) AS n
  FROM quoted q LEFT JOIN first f ON f.conv = q.conv AND f.norm = q.norm GROUP BY ALL),
top AS (
  SELECT conv, turn, text, passage, level, sum(n) AS lines,
    max(CASE WHEN source IS NOT NULL THEN {{'n': n, 's': source}} END) AS best FROM vote GROUP BY ALL),
target AS (SELECT conv, turn, level, CASE WHEN best.n * 2 >= lines THEN best.s END AS source FROM top),
reply AS (
  SELECT conv, turn, max(level) AS quote_depth, count(*) AS n_passages, count(source) AS n_linked,
    max(CASE WHEN source IS NOT NULL THEN {{'near': -level, 's': source}} END).s AS reply_to FROM target GROUP BY ALL),
walk AS (
  SELECT conv, turn, reply_to AS up FROM reply WHERE reply_to IS NOT NULL
  UNION SELECT w.conv, w.turn, r.reply_to FROM walk w JOIN reply r ON r.conv = w.conv AND r.turn = w.up WHERE r.reply_to IS NOT NULL),
root AS (SELECT conv, turn, min(up) AS root FROM walk GROUP BY ALL)
SELECT s.conv AS conv_id, s.turn, s.role, CAST(coalesce(r.quote_depth, 0) AS BIGINT) AS quote_depth,
  CAST(coalesce(r.n_passages, 0) AS BIGINT) AS n_passages, CAST(coalesce(r.n_linked, 0) AS BIGINT) AS n_linked, r.reply_to,
  CASE WHEN s.conv IS NOT NULL THEN coalesce(o.root, s.turn) END AS thread, sha256(s.own_text) AS own_sha256,
  CAST(length(s.own_text) AS BIGINT) AS own_chars
FROM said s LEFT JOIN reply r ON r.conv = s.conv AND r.turn = s.turn LEFT JOIN root o ON o.conv = s.conv AND o.turn = s.turn"""


@register("op3_quote_linking", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in reply order, without quotations (as a checksum and a length)."""
    out = QL.link(table(spark, sf_dir, "conversations"))
    own = F.coalesce("own_text", F.lit(""))
    return out.withColumn("own_sha256", F.sha2(own, 256)).withColumn("own_chars", F.length(own).cast("long")).drop("own_text")


@register("op5_forest_secrets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates and secrets of every whole text."""
    trees = SF.train(SF.labelled_findings(spark))
    out = SF.scan(table(spark, sf_dir, "documents"), trees)
    return out.withColumn("masked_sha256", F.sha2(F.coalesce("masked_text", F.lit("")), 256)).withColumn(
        "secrets", F.array_join("secrets", ",")).drop("masked_text")


#: crc32 of a decimal number in DuckDB, bit by bit.
CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))))"""

OP11_SQL = f"""
WITH own AS (
  SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv, conv - conv % 5 AS base, {CRC32_SQL.format('conv')} % 9 AS h FROM own),
steps AS (
  SELECT c.conv, 0 AS part, o.place, o.turn FROM convs c JOIN own o ON o.conv = c.base AND o.place <= c.h
  UNION ALL SELECT c.conv, 1, o.place, o.turn FROM convs c JOIN own o ON o.conv = c.conv AND o.place > c.h),
seqs AS (SELECT c.conv, coalesce(list(s.turn ORDER BY part, place) FILTER (s.turn IS NOT NULL), []) AS seq FROM convs c LEFT JOIN steps s ON s.conv = c.conv GROUP BY c.conv),
prefixes AS (SELECT conv, len(seq) AS size, d AS depth, seq[1:d] AS prefix FROM (SELECT conv, seq, unnest(range(len(seq) + 1)) AS d FROM seqs) t),
node AS (
  SELECT prefix, depth, min(conv) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(prefix[depth].text)) END AS saved,
    sha256(coalesce(string_agg(conv, ',' ORDER BY conv) FILTER (size = depth), '')) AS ends_sha256 FROM prefixes GROUP BY prefix, depth),
family AS (
  SELECT n.prefix, n.depth, n.conv_id, p.conv_id AS parent_conv_id, n.n_convs, n.saved, n.ends_sha256,
    (SELECT count(*) FROM node c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
  FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]),
up AS (SELECT prefix[1:d] AS prefix, d AS depth, saved, n_children FROM (SELECT prefix, saved, n_children, unnest(range(depth + 1)) AS d FROM family) t),
sums AS (SELECT prefix, depth, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM up GROUP BY prefix, depth)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, f.parent_conv_id, f.n_convs, f.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM family f JOIN sums s ON s.prefix = f.prefix AND s.depth = f.depth"""


@register("op11_prefix_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return PT.trie(table(spark, sf_dir, "conversations"), share=5, longest=9)


OP12_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)"""


@register("op12_exact_dedup", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal texts of all documents."""
    return ED.classes(table(spark, sf_dir, "documents"))


_MANIFEST = ["doc_id", "source", "lang", "n_chars", "text"]
_ENC = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"


def _op13_sql() -> str:
    head = " || ".join(_ENC.format(c) for c in _MANIFEST[:-1])

    def tree(name: str, start: str) -> str:
        return f"""{name}(src, lvl, pos, n, h) AS ({start}
  UNION ALL SELECT src, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY src, lvl, pos // 3, n),
{name}_side AS (
  SELECT a.src, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {name} a JOIN {name} b ON b.src = a.src AND b.lvl = a.lvl AND b.pos // 3 = a.pos // 3 WHERE a.n > 1 GROUP BY a.src, a.lvl, a.pos)"""
    return f"""
WITH RECURSIVE leaf AS (
  SELECT row_number() OVER () AS row, doc_id, CASE WHEN source IS NULL THEN '' ELSE '+' || source END AS src, sha256({head} || {_ENC.format('text')}) AS leaf,
    CASE WHEN {CRC32_SQL.format('doc_id')} % 2 = 0 THEN sha256({head} || {_ENC.format("replace(text, chr(10), '')")}) ELSE sha256({head} || {_ENC.format('text')}) END AS seen FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY src) AS n FROM leaf),
{tree('low', 'SELECT src, 0::BIGINT, pos, n, leaf FROM placed')},
subroots AS (SELECT src, h AS subroot, row_number() OVER (ORDER BY src) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
{tree('high', "SELECT '', 0::BIGINT, pos, n, subroot FROM subroots")},
walk(row, src, up, lvl, pos, proof, h) AS (
  SELECT row, src, false, 0::BIGINT, pos, '', seen FROM placed
  UNION ALL
  SELECT w.row, w.src, w.up OR l.pos IS NULL, CASE WHEN w.up OR l.pos IS NOT NULL THEN w.lvl + 1 ELSE 0 END,
    CASE WHEN w.up OR l.pos IS NOT NULL THEN w.pos // 3 ELSE s.pos END,
    w.proof || coalesce(CASE WHEN w.up THEN u.l || u.r ELSE l.l || l.r END, ''),
    CASE WHEN w.up THEN sha256(u.l || w.h || u.r) WHEN l.pos IS NOT NULL THEN sha256(l.l || w.h || l.r) ELSE w.h END
  FROM walk w LEFT JOIN low_side l ON NOT w.up AND l.src = w.src AND l.lvl = w.lvl AND l.pos = w.pos
    LEFT JOIN high_side u ON w.up AND u.lvl = w.lvl AND u.pos = w.pos JOIN subroots s ON s.src = w.src
  WHERE NOT w.up OR u.pos IS NOT NULL),
ended AS (SELECT row, arg_max(proof, up::INT * 1000 + lvl) AS proof, arg_max(h, up::INT * 1000 + lvl) AS h FROM walk GROUP BY row)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM placed p JOIN subroots s ON s.src = p.src JOIN ended e ON e.row = p.row CROSS JOIN (SELECT h FROM high WHERE n = 1) r"""


@register("op13_merkle_witnesses", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and witness of every document, and the root that a tampered text folds to."""
    docs = table(spark, sf_dir, "documents").select(*_MANIFEST)
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.col("text").isNotNull()
    leaves = docs.withColumn("leaf", MK.leaf_hash(*_MANIFEST)).withColumn("text", F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    leaves = leaves.withColumn("seen", MK.leaf_hash(*_MANIFEST)).select("doc_id", "source", "leaf", "seen")
    out = MK.manifest(leaves).withColumn("folded_root", MK.folded("seen"))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(MK.proof(), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
