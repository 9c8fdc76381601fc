"""Secret scans: candidates by pattern, false positives removed by a random forest, with DataFrame operations only.

candidates() takes what is assigned to a word that asks for a secret (password: ..., "token" = ..., Bearer ...), of SHORT or more
signs other than white space, quotes, commas and semicolons, and every other run of at least LEAST key characters
([A-Za-z0-9_+/=-]), digits or not; with up to NEAR characters before and after it. described() gives each its features: length,
character transitions, shares of kinds of characters, dictionary coverage, whether it looks like a path, and the words beside
it. The forest is grown on the labelled findings in findings.tsv, and becomes one expression: a mean of nested CASEs.

Defined cases: a null or empty text has no findings; a candidate found twice in a text is two findings; repeated rows give
repeated findings; a null doc_id comes out as it is; scores are exact multiples of what trees vote, and a tie of votes (a score
of one half) is a secret; very long texts are scanned whole; an empty table has no findings; extra columns are not looked at,
whatever their names.
"""

from __future__ import annotations

import functools
import pathlib
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from versica.llm.common import id_text
from versica.llm.tree import Tree, grow

LEAST, SHORT, NEAR = 16, 6, 40
#: What asks for a value, up to the value.
ASKED = r"""(?i:(?:passw(?:or)?d|passwd|pwd|secret|token|credentials?|key)["']?\s{0,3}[:=]\s{0,3}["']?|bearer\s{1,3})"""
CANDIDATE = rf"""{ASKED}[^\s"',;]{{{SHORT},}}|[A-Za-z0-9_+/=-]{{{LEAST},}}"""
TREES, DEPTH = 25, 6
#: Fixed words: what names a secret beside it, what names something else, and words that identifiers are made of.
ASKING = "api apikey auth authorization bearer client credential credentials key passwd password private pwd secret token".split()
DENYING = "card checksum commit digest example etag hash id invoice md5 order phone placeholder rev revision sample sha sha1 sha256 test tracking uuid version".split()
DICTIONARY = "about access account admin and api app author backup base blob build cache client code commit common component config content core count create data date default demo dev document dummy error example feature file final form from function get group handler head home html http image index info input item java json key lib line link list local log main master message model module name native node note object online order output page part password path placeholder plugin post prod project query read release report request resource response result root sample script secret section server service session set setting site size source start state static string style sub system table task template test text the thread time title token tool type update url user util value version video view web with word write xxxx your".split()
FINDINGS = pathlib.Path(__file__).with_name("findings.tsv")
FEATURES = ("n", "moves", "digits", "uppers", "marks", "kinds", "repeats", "covered", "path", "asks", "denies", "assigned", "groups")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, place (ordinal among a text's candidates, from 0), candidate, before, after."""
    rows = id_text(docs, id_col, text_col).where(F.col("text").rlike(CANDIDATE))
    around = F.transform(F.split("text", CANDIDATE, -1), lambda x: F.struct(F.right(x, F.lit(NEAR)).alias("tail"), F.left(x, F.lit(NEAR)).alias("head")))
    parts = rows.select("doc_id", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), around.alias("rest"))
    each = parts.select("doc_id", F.posexplode("found").alias("place", "found"), "rest")
    each = each.withColumn("candidate", F.regexp_replace("found", f"^{ASKED}", "")).withColumn("asked", F.expr("left(found, length(found) - length(candidate))"))
    before = F.right(F.concat(F.col("rest")[F.col("place")]["tail"], "asked"), F.lit(NEAR))
    return each.select("doc_id", F.col("place").cast("long").alias("place"), "candidate", before.alias("before"), F.col("rest")[F.col("place") + 1]["head"].alias("after"))


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.length(text)


def described(found: DataFrame) -> DataFrame:
    """found(candidate, before, after, ...) with a double column for each of FEATURES."""
    c = F.col("candidate")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    around = F.lower(F.concat(F.regexp_replace("before", r"([a-z])([A-Z])", "$1 $2"), F.lit(" "), F.regexp_replace("after", r"([a-z])([A-Z])", "$1 $2")))
    named = lambda words: r"(^|[^a-z0-9])(" + "|".join(words) + r")([^a-z0-9]|$)"
    values = {
        "n": F.length(c),
        "moves": F.length(F.regexp_replace(kinds, r"(.)\1*", "$1")) / F.length(c),
        "digits": _share(c, "[0-9]"),
        "uppers": _share(c, "[A-Z]"),
        "marks": _share(c, "[^A-Za-z0-9]"),
        "kinds": F.size(F.array_distinct(F.split(c, ""))) / F.least(F.length(c), F.lit(36)),
        "repeats": _share(c, r"(.)\1"),
        "covered": 1 - F.length(F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / F.length(c),
        "path": (c.contains("/") & _either(F.col("before").rlike(r"[/.:\\]$"), c.rlike(r"^/?([a-z0-9_-]{2,20}/){2,}")) | F.col("after").rlike(r"^\.[a-z]{2,4}\b")),
        "asks": around.rlike(named(ASKING)),
        "denies": around.rlike(named(DENYING)),
        "assigned": F.col("before").rlike(r"[:=]\s*[\"']?$"),
        "groups": c.rlike(r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$") | c.rlike(r"^[0-9-]+$"),
    }
    return found.select("*", *[v.cast("double").alias(k) for k, v in values.items()])


def _either(a: Column, b: Column) -> Column:
    return a | b


def labelled(spark: SparkSession) -> DataFrame:
    """The labelled findings: id, candidate, before, after, secret (1 or 0)."""
    plain = lambda x: x.replace("\\n", "\n").replace("\\t", "\t").replace("\\\\", "\\")
    rows = [line.split("\t") for line in FINDINGS.read_text().splitlines()[1:]]
    return spark.createDataFrame([(i, plain(c), plain(b), plain(a), int(y)) for i, (y, c, b, a) in enumerate(rows)], "id long, candidate string, before string, after string, secret int")


def grown(rows: list) -> tuple[Tree, ...]:
    """TREES trees, each on a sample with replacement of rows(secret, FEATURES)."""
    pick = random.Random(7)
    trees = []
    for _ in range(TREES):
        drawn = [rows[pick.randrange(len(rows))] for _ in rows]
        trees.append(grow([[r[f] for f in FEATURES] for r in drawn], [r.secret for r in drawn], DEPTH, 3, pick, 4))
    return tuple(trees)


@functools.cache
def _forest(application: str) -> tuple[Tree, ...]:
    spark = SparkSession.getActiveSession()
    return grown(described(labelled(spark)).orderBy("id").select("secret", *FEATURES).collect())  # of a few hundred rows


def forest(spark: SparkSession) -> tuple[Tree, ...]:
    return _forest(spark.sparkContext.applicationId)


def voted(trees: tuple[Tree, ...]) -> Column:
    """The trees' mean share of secrets, as an expression over FEATURES."""

    def one(t: Tree) -> Column:
        return F.lit(float(round(t[0], 6))) if len(t) == 1 else F.when(F.col(FEATURES[t[0]]) <= t[1], one(t[2])).otherwise(one(t[3]))

    total = one(trees[0])
    for t in trees[1:]:
        total = total + one(t)
    return F.round(total / len(trees), 6)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, place, candidate, score, is_secret for every candidate of docs."""
    trees = forest(docs.sparkSession)
    found = described(candidates(docs, id_col, text_col)).withColumn("score", voted(trees))
    return found.select("doc_id", "place", "candidate", "score", (F.col("score") >= 0.5).alias("is_secret"))
