"""Secret scans: a random forest removes false positives.

Method: candidates are all runs of 16 or more key characters, however many a word has and with or
without digits; the parts of a web token (header.payload.signature) are one run.  Each is described by
its length, character transitions, coverage by dictionary pieces, path shape, neighbouring words and the
piece of its word since the run before; runs of a list ("A","B") share the piece before the list.  A random forest trained from labelled findings (a parameter; the
default is made of the templates below) decides which candidates are secrets.

The trained trees are turned into column expressions, so scoring takes place inside the row: one
pass over whole texts, no shuffle, no Python.  Training rows are few and bounded by their table.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, fresh, only

TREES, DEPTH, SEED = 24, 6, 7
CORE = r"[A-Za-z0-9+/=_\-]{16,}"
#: A web token with the dots between its two to five parts, or a run of key characters.
RUN = r"(?:[A-Za-z0-9+/=_\-]*eyJ[A-Za-z0-9_\-]{8,}(?:\.[A-Za-z0-9_\-]*){0,3}\.[A-Za-z0-9_\-]+|" + CORE + ")"
#: Runs with nothing but list marks between them (possessive: matched by a loop, whatever the number).
LIST = RUN + r"(?:[\"'`,;|\[\](){}]+" + RUN + ")*+"
MASK = "<SECRET>"
#: Pieces of common words, words that name secrets, words that name harmless strings.
PIECES = ["the", "and", "ing", "tion", "ment", "able", "with", "from", "that", "this", "page", "file", "user", "name", "index", "image",
          "test", "data", "lich", "schaft", "ung", "eau", "ción", "mente", "des", "les", "que", "ent", "http", "www", "html", "example"]
NAMES = ["key", "token", "secret", "password", "passwd", "pwd", "auth", "credential", "api", "bearer", "private", "access"]
HARMLESS = ["commit", "sha", "sha1", "sha256", "md5", "hash", "checksum", "digest", "uuid", "guid", "id", "build", "revision", "etag",
            "version", "phone", "isbn", "order", "invoice", "image", "page", "file"]
FEATURES = ["length", "transitions", "kinds", "digits", "uppers", "hex", "distinct", "coverage", "slashes", "dots", "dashes", "quoted", "assigned",
            "named", "harmless", "prefix", "all_digits"]


def candidates(text: Column) -> Column:
    """Array of {word, core, before, after} of a text, in order: one for each run, with the piece of the word around it."""
    def of(words: Column) -> Column:
        hits = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: (F.length(F.get(words, i)) >= 16) & F.get(words, i).rlike(CORE))
        near = lambda a, b: F.lower(F.concat_ws(" ", *[F.coalesce(x, F.lit("")) for x in (a, b)]))
        at = lambda i, d: F.when(i + d >= 0, F.get(words, i + d))

        def split(i: Column) -> Column:
            word = F.get(words, i)
            return F.struct(F.regexp_extract_all(word, F.lit(LIST), 0).alias("lists"), F.split(word, LIST).alias("between"),
                            near(at(i, -2), at(i, -1)).alias("before"), F.lower(F.coalesce(F.get(words, i + 1), F.lit(""))).alias("after"))

        def runs(w: Column) -> Column:
            def of_list(part: Column, k: Column) -> Column:
                last, rest = k + 1 == F.size(w["lists"]), F.get(w["between"], k + 1)
                left, right = F.get(w["between"], k), F.when(last, rest).otherwise(F.regexp_extract(rest, "^[^A-Za-z0-9]*", 0))
                return F.transform(F.regexp_extract_all(part, F.lit(RUN), 0), lambda core: F.struct(
                    F.concat(left, core, right).alias("word"), core.alias("core"),
                    F.when(k == 0, w["before"]).otherwise("").alias("before"), F.when(last, w["after"]).otherwise("").alias("after")))

            return F.flatten(F.transform(w["lists"], of_list))

        return F.flatten(F.transform(F.transform(hits, split), runs))

    return F.when(F.coalesce(text.rlike(CORE), F.lit(False)), F.transform(F.array(F.split(text, SPACE)), of)[0]).otherwise(F.array())


def _one_of(text: Column, words: list[str]) -> Column:
    return text.rlike(r"(?:^|[^a-z0-9])(?:" + "|".join(words) + r")(?:$|[^a-z0-9])").cast("double")


def describe(c: Column) -> Column:
    """A candidate with its features, as a struct."""
    core, word = c["core"], c["word"]
    n = F.length(core)
    count = lambda x, cls: n - F.length(F.regexp_replace(x, cls, ""))
    inside = F.concat_ws(" ", c["before"], F.lower(F.regexp_replace(word, RUN, " ")), F.lower(F.regexp_extract(core, "^[A-Za-z_]{2,24}=", 0)))
    f = {
        "length": n,
        "transitions": F.size(F.split(core, r"(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])|(?<=[a-z])(?=[A-Z])")) / n,
        "kinds": core.rlike("[a-z]").cast("int") + core.rlike("[A-Z]").cast("int") + core.rlike("[0-9]").cast("int") + core.rlike("[^A-Za-z0-9]").cast("int"),
        "digits": count(core, "[0-9]") / n,
        "uppers": count(core, "[A-Z]") / n,
        "hex": core.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "distinct": F.size(F.array_distinct(F.split(core, ""))) / n,
        "coverage": count(F.lower(core), "(?:" + "|".join(PIECES) + ")") / n,
        "slashes": count(core, "/") + (F.length(word) - F.length(F.regexp_replace(word, "://|[?&]", ""))),
        "dots": F.length(word) - F.length(F.regexp_replace(word, r"[.@]", "")) - count(core, r"[.]"),
        "dashes": count(core, "[-_]"),
        "quoted": word.rlike("[\"'`]"),
        "assigned": inside.rlike("[=:]") | core.rlike("^[A-Za-z_]{2,24}="),
        "named": F.greatest(_one_of(inside, NAMES), inside.rlike("(?:" + "|".join(NAMES) + ")[a-z0-9_]*[\"']?[\\x20]*[=:]").cast("double")),
        "harmless": F.greatest(_one_of(inside, HARMLESS), _one_of(c["after"], HARMLESS)),
        "prefix": core.rlike(r"^(?:AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|xox[abpr]-|sk-|sk_live_|pk_live_|AIza|eyJ|SG\.)"),
        "all_digits": core.rlike("^[0-9]+$"),
    }
    return F.struct(c["word"].alias("word"), core.alias("core"), *[f[k].cast("double").alias(k) for k in FEATURES])


def labelled_findings(spark: SparkSession, variants: int = 40) -> DataFrame:
    """(text, secret): a finding each, from templates filled with hashes of a counter."""
    hexa, hexb = F.sha1(F.concat(F.lit("a"), "i")), F.md5(F.concat(F.lit("b"), "i"))
    mixed = F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit("c"), "i"), 256))), "[=+/]", "k")
    digits = F.regexp_replace(F.sha1(F.concat(F.lit("d"), "i")), "[a-f]", "4")
    letters = F.translate(mixed, "0123456789", "QzXkVbNmWj")
    long = F.element_at(F.array(*[F.lit(w) for w in (
        "Geschwindigkeitsbegrenzung", "internationalization", "Wissenschaftlichkeit", "responsabilidades", "anticonstitutionnellement", "uncharacteristically",
        "Arbeiterunfallversicherungsgesetz", "incomprehensibilities", "CONGRATULATIONS-EVERYONE", "getElementsByTagName", "addEventListenerFor", "some_function_name_here",
        "state-of-the-art-solutions", "mother-in-law-to-be", "and/or/either/neither", "/wp-content/uploads/gallery", "XMLHttpRequestFactory", "DONAUDAMPFSCHIFFFAHRT",
        "zzzzzzzzzzzzzzzzzzzzz", "hahahahahahahahahaha", "________________________", "=======================", "/about/company/history", "desenvolvimento-sustentavel")]),
        (F.col("i") % 24 + 1).cast("int"))
    word = F.element_at(F.array(*[F.lit(w) for w in ("station", "garden", "nation", "thereing", "handeln", "verstehen", "maison", "camino")]), (F.col("i") % 8 + 1).cast("int"))
    q = F.concat
    lit = F.lit
    secret = [
        q(word, lit(' token = "'), hexa, lit('" '), word), q(lit("api_key: "), hexb, lit(" "), word), q(word, lit(" secret="), mixed),
        q(lit("password = '"), F.substring(mixed, 1, 20), lit("' "), word), q(lit("AWS AKIA"), F.upper(F.substring(hexa, 1, 16)), lit(" "), word),
        q(lit("use ghp_"), F.substring(mixed, 1, 36), lit(" for")), q(lit("Bearer eyJ"), mixed, lit(" ok")), q(word, lit(' TOKEN = "'), F.upper(hexa), lit('"!! '), word),
        q(lit('token = "'), hexa, lit('"### '), word), q(word, lit(" auth sk_live_"), F.substring(mixed, 1, 24)), q(lit("access_key="), mixed, lit(" "), word),
        q(lit("private key: "), mixed, lit(" "), word), q(lit("xoxb-"), F.substring(digits, 1, 12), lit("-"), F.substring(mixed, 1, 24)),
        q(lit("Bearer eyJ"), F.substring(mixed, 1, 24), lit(".eyJ"), mixed, lit("."), mixed, lit(" ok")), q(lit('{"token":"'), hexa, lit('"} '), word),
        q(lit("https://api.example.com/v?access_token="), mixed, lit(" "), word), q(lit("&secret="), hexa, lit(" "), word),
        q(word, lit(' secret = "'), letters, lit('" '), word), q(lit("api_key="), F.substring(letters, 1, 24), lit(" "), word), q(word, lit(' "token":"'), letters, lit('"} '), word)]
    harmless = [
        q(lit("commit "), hexa, lit(" "), word), q(lit("sha256: "), F.sha2(hexa, 256), lit(" ok")), q(lit("md5 "), hexb, lit(" "), word),
        q(lit("uuid "), F.substring(hexb, 1, 8), lit("-"), F.substring(hexb, 9, 4), lit("-4"), F.substring(hexb, 13, 3), lit("-a"), F.substring(hexb, 16, 3), lit("-"), F.substring(hexb, 19, 12)),
        q(word, lit(" "), F.substring(digits, 1, 16), lit(" "), word), q(word, lit(" "), F.substring(digits, 1, 16), lit("### "), word),
        q(lit("see http://"), word, lit(".example.com/page/file_"), F.substring(digits, 1, 4), lit(".html now")),
        q(lit("/usr/share/"), word, lit("/data/index_file_"), F.substring(digits, 1, 3)), q(lit("order id: "), F.substring(digits, 1, 18), lit(" "), word),
        q(word, lit("tionmentableing2024the "), word), q(lit("image file_name_with_the_user_index_"), F.substring(digits, 1, 2), lit(" "), word),
        q(lit("phone 0049-"), F.substring(digits, 1, 14), lit(" "), word), q(word, lit(" ."), F.substring(digits, 1, 2), lit("@mail7.example.com "), word),
        q(lit("checksum = "), hexb, lit(" "), word), q(lit("version: build-"), F.substring(digits, 1, 12), lit("-"), word),
        q(lit("================2==================== "), word), q(word, lit(" ----------------1--------------- "), word),
        q(word, lit(" "), long, lit(" "), word), q(word, lit(' "'), long, lit('", '), word), q(lit("("), long, lit(". "), word),
        q(lit("see https://www."), word, lit(".example.com/"), F.lower(long), lit("/ "), word), q(lit("see http://example.com/?page="), F.lower(long), lit(" "), word),
        q(lit('{"commit":"'), hexa, lit('"} '), word), q(lit('<a href="/'), F.lower(long), lit('">'), word)]
    rows = spark.range(variants).withColumn("i", F.col("id").cast("string"))
    out = [F.struct(t.alias("text"), F.lit(y).alias("secret")) for y, ts in ((1, secret), (0, harmless)) for t in ts]
    return rows.select(F.explode(F.array(*out)).alias("r")).select("r.*")


def train(findings: DataFrame) -> list:
    """Trees, as nested (feature, threshold, left, right) or leaf votes, from (text, secret 0/1).

    Rows without a candidate or with a null are left out; if only one label is left, every
    candidate gets it."""
    rows = findings.dropna().select(F.col("secret").cast("double").alias("label"), F.explode(F.transform(candidates(F.col("text")), describe)).alias("c"))
    rows = rows.select("label", "c.*").coalesce(1)
    seen = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(seen) < 2:
        return [seen[0] if seen else 0.0]
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="f", labelCol="label").fit(
        VectorAssembler(inputCols=FEATURES, outputCol="f").transform(rows))
    return [_parse(iter(t.toDebugString.splitlines()[1:])) for t in model.trees]


def _parse(lines):
    """A tree from its printed form."""
    line = next(lines).strip()
    if m := re.match(r"Predict: ([\d.E-]+)", line):
        return float(m[1])
    feature, at = re.match(r"If \(feature (\d+) <= ([-\d.E]+)\)", line).groups()
    left = _parse(lines)
    next(lines)  # the matching Else
    return int(feature), float(at), left, _parse(lines)


def vote(trees: list, c: Column) -> Column:
    """Share of trees that call a described candidate a secret."""
    def expr(t):
        if isinstance(t, float):
            return F.lit(t)
        return F.when(c[FEATURES[t[0]]] <= t[1], expr(t[2])).otherwise(expr(t[3]))

    return reduce(lambda a, b: a + b, map(expr, trees)) / len(trees)


def _masked(hits: Column, text: Column) -> Column:
    """The text without the hits; longer ones first, as a shorter one may be a part of them."""
    longest = F.sort_array(F.transform(F.array_distinct(hits), lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))), asc=False)
    return F.aggregate(longest, text, lambda s, h: F.replace(s, h["x"], F.lit(MASK)))


def _found(trees: list, text: Column) -> tuple[Column, Column]:
    described = F.transform(candidates(text), describe)
    return described, lambda d: F.filter(d, lambda c: vote(trees, c) >= 0.5)


def scan(docs: DataFrame, trees: list, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_candidates, n_secrets, secrets (distinct cores, in order of first place) and masked text.

    Null texts stay null with no candidates; rows with null or repeated ids are scanned row by row.  Extra columns
    are not read; an empty table gives an empty result.
    """
    t = only(docs, id_col, text_col).toDF("id", "text")
    described, keep = _found(trees, F.col("text"))
    t = t.withColumn("found", described)
    t = t.select("id", "text", F.size("found").cast("long").alias("n_candidates"),
                 F.transform(keep(F.col("found")), lambda c: c["core"]).alias("hits"))
    masked = _masked(F.col("hits"), F.col("text"))
    return t.select(F.col("id").alias(id_col), "n_candidates", F.size("hits").cast("long").alias("n_secrets"),
                    F.array_distinct("hits").alias("secrets"), masked.alias("masked_text"))


def mask(docs: DataFrame, trees: list, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, with secrets in the text replaced by MASK."""
    name = fresh(docs, "__hits")
    described, keep = _found(trees, F.col(text_col))
    t = docs.withColumn(name, F.transform(keep(described), lambda c: c["core"]))
    return t.withColumn(text_col, _masked(F.col(name), F.col(text_col))).drop(name)
