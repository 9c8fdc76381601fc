"""More registered queries: reading order, side tables, checks, reports and changes. queries.py imports this module at its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from versica.operators import extras, quality, reports, search
from versica.plans.queries import HITS, KEYS, PHRASE, query, table, works
from versica.sources import corpus, paths


@query(r"""WITH files AS (SELECT DISTINCT CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS dataset_no, 'poet.' || lang || '.' || CAST((doc_id % 40) * 250 AS VARCHAR) || '.json' AS file FROM documents)
SELECT dataset_no, file, row_number() OVER (ORDER BY dataset_no, regexp_replace(file, '\d+', '', 'g'), CAST(regexp_extract(file, '(\d+)\D*$', 1) AS BIGINT), file) - 1 AS place FROM files""")
def shard_order(spark, sf):
    """Shards in natural order: 2000 before 10000."""
    d = table(spark, sf, "documents")
    return corpus.file_order(d.select(F.when(F.col("lang") == "en", 0).otherwise(1).alias("dataset_no"), F.concat(F.lit("poet."), "lang", F.lit("."), ((F.col("doc_id") % 40) * 250).cast("string"), F.lit(".json")).alias("file")))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN lang WHEN 2 THEN source ELSE NULL END AS value FROM documents")
def json_path_null(spark, sf):
    """A JSON null that is there counts; only what is not there falls through."""
    d = table(spark, sf, "documents")
    k = F.col("doc_id") % 4
    record = F.when(k == 0, F.concat(F.lit('{"a": null, "b": "'), "lang", F.lit('"}'))).when(k == 1, F.concat(F.lit('{"b": "'), "lang", F.lit('"}'))).when(k == 2, F.concat(F.lit('{"a": "'), "source", F.lit('", "b": "x"}'))).otherwise("{}")
    return d.select("doc_id", paths.value(record, "$.a|$.b").alias("value"))


@query("SELECT name, bad = 0 AS ok, bad FROM (SELECT 'title folded' AS name, count(*) FILTER (doc_id % 7 = 0) AS bad FROM documents UNION ALL SELECT 'title without spaces', count(*) FILTER (doc_id % 11 = 0) FROM documents UNION ALL SELECT 'title not anonymous', count(*) FILTER (doc_id % 13 = 0 AND doc_id % 7 <> 0 AND doc_id % 11 <> 0) FROM documents)")
def text_form_checks(spark, sf):
    """Planted: a traditional character, a wide space, an anonymous name."""
    d = table(spark, sf, "documents")
    k = lambda n: F.col("doc_id") % n == 0
    title = F.concat(F.when(k(7), "馬").otherwise(""), F.when(k(11), "　").otherwise(""), F.when(k(13), "不详").otherwise("诗"))
    return quality.text_form(d.select(title.alias("title")), ["title"])


@query("SELECT 'lang members' AS name, (SELECT count(*) FROM (SELECT DISTINCT lang FROM documents WHERE lang NOT IN ('de', 'en', 'fr'))) = 0 AS ok, (SELECT count(*) FROM (SELECT DISTINCT lang FROM documents WHERE lang NOT IN ('de', 'en', 'fr'))) AS bad UNION ALL SELECT 'lang of rows', count(*) FILTER (lang NOT IN ('de', 'en', 'fr')) = 0, count(*) FILTER (lang NOT IN ('de', 'en', 'fr')) FROM documents")
def dimension_checks(spark, sf):
    """A member too many, and the rows that have it."""
    d = table(spark, sf, "documents")
    return quality.dimension(d, "lang", d.select("lang").distinct(), ["de", "en", "fr"])


@query("""WITH s AS (SELECT l_orderkey + CASE WHEN l_linenumber = 7 THEN 100000000 ELSE 0 END AS uid, l_linenumber, CASE WHEN l_linenumber = 3 THEN 'a' || chr(31) ELSE 'a' || chr(31) || 'b' END AS tags, CASE WHEN l_linenumber = 4 THEN '1.5' ELSE '17' END AS at, CASE WHEN l_linenumber = 5 THEN 'x/y.png' ELSE 'y.png' END AS image FROM lineitem)
SELECT name, CASE WHEN name = 'uid known' THEN bad <= n * 0.01 ELSE bad = 0 END AS ok, bad FROM (SELECT count(*) AS n, count(*) FILTER (uid IS NULL) AS "uid there", count(*) FILTER (l_linenumber = 3) AS "tags members", count(*) FILTER (l_linenumber = 4) AS "at seconds", count(*) FILTER (l_linenumber = 5) AS "image bare",
  (SELECT count(*) FROM (SELECT uid FROM s GROUP BY uid HAVING count(*) > 1)) AS "uid unique", count(*) FILTER (uid NOT IN (SELECT o_orderkey FROM orders)) AS "uid known" FROM s) UNPIVOT (bad FOR name IN ("uid there", "tags members", "at seconds", "image bare", "uid unique", "uid known"))""")
def side_table_checks(spark, sf):
    """Lines of orders as a side table with planted faults: repeated and unknown keys, empty list members, broken times, folders in names."""
    n = F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select((F.col("l_orderkey") + F.when(n == 7, 100000000).otherwise(0)).alias("uid"), F.when(n == 3, "a\x1f").otherwise("a\x1fb").alias("tags"), F.when(n == 4, "1.5").otherwise("17").alias("at"), F.when(n == 5, "x/y.png").otherwise("y.png").alias("image"))
    return quality.side_table(rows, table(spark, sf, "orders").select(F.col("o_orderkey").alias("uid")), "uid", ["tags"], ["at"], ["image"])


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'no JSON' WHEN 2 THEN 'no list or object' END AS fault FROM documents")
def file_faults(spark, sf):
    k = F.col("doc_id") % 5
    value = F.when(k == 0, " ").when(k == 1, '{"a": ').when(k == 2, "17").when(k == 3, F.to_json(F.struct("text"))).otherwise(F.concat(F.lit("["), F.to_json(F.struct("lang")), F.lit("]")))
    return quality.file_faults(table(spark, sf, "documents").select("doc_id", value.alias("value"))).select("doc_id", "fault")


@query("SELECT o_orderkey, arg_max(l_partkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey) AS strain FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 40) ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def strains_attach(spark, sf):
    """A side table's last value for each work; works without one stay."""
    side = table(spark, sf, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("strain"), "l_linenumber")
    return extras.attached(table(spark, sf, "orders").select("o_orderkey"), side, "o_orderkey", "strain", "l_linenumber")


@query("SELECT count(*) AS n_keys, count(o_orderkey) AS n_joined FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey")
def strains_completeness(spark, sf):
    side = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return extras.completeness(table(spark, sf, "orders").where("o_orderstatus <> 'P'"), side, "o_orderkey")


@query("SELECT doc_id, CAST(floor((sum(strlen(coalesce(text, ''))) OVER (ORDER BY doc_id) - strlen(coalesce(text, ''))) / 100000) AS BIGINT) AS shard FROM documents")
def reshard_by_bytes(spark, sf):
    d = table(spark, sf, "documents")
    return extras.sized_shards(d.select("doc_id", "text"), "doc_id", F.octet_length(F.coalesce("text", F.lit(""))), 100_000).select("doc_id", "shard")


@query("SELECT source, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest([source, CASE WHEN doc_id % 3 = 0 THEN 'src0' WHEN doc_id % 3 = 1 THEN lang END]) AS source FROM documents) WHERE source IS NOT NULL GROUP BY source")
def source_counts(spark, sf):
    """Sources of rows, first and later ones together, each once a row."""
    k = F.col("doc_id") % 3
    more = F.when(k == 0, F.array(F.lit("src0"))).when(k == 1, F.array("lang"))
    return extras.source_counts(table(spark, sf, "documents").select("source", more.alias("more_sources")))


@query("SELECT c_custkey AS author, count(*) AS n_works, array_to_string(list_sort(list(o_orderkey))[1:3], ',') AS samples FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey ORDER BY n_works DESC, author LIMIT 50")
def authors_by_works(spark, sf):
    """The first fifty are the feature here."""
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("author"), "o_orderkey")
    return search.page(reports.authors_by_works(rows, "author", "o_orderkey"), [F.desc("n_works"), "author"], 50).select("author", "n_works", F.array_join("samples", ",").alias("samples"))


@query("SELECT source, count(*) AS n, count(*) FILTER (doc_id % 6 = 0) AS n_anonymous FROM documents GROUP BY source")
def anonymous_share(spark, sf):
    return reports.anonymous_share(table(spark, sf, "documents"), "source", F.when(F.col("doc_id") % 6 > 0, F.col("lang")).when(F.col("doc_id") % 12 == 0, ""))


@query("SELECT source, greatest(1, CAST(ceil(count(*) / 7.0) AS BIGINT)) AS pages, least(greatest(max(doc_id) % 9 - 2, 1), greatest(1, CAST(ceil(count(*) / 7.0) AS BIGINT))) AS page FROM documents GROUP BY source")
def pager(spark, sf):
    by = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), F.max("doc_id").alias("m"))
    return by.select("source", reports.pager(F.col("n"), 7, F.col("m") % 9 - 2).alias("p")).select("source", "p.pages", "p.page")


@query(f"WITH {HITS}, {KEYS}, n AS (SELECT (SELECT count(*) FROM hit) AS n_lines, (SELECT count(DISTINCT work_id) FROM hit) AS n_works, (SELECT count(DISTINCT k) FROM keys) AS n_texts) SELECT n_lines, n_works, n_texts, least(11, n_texts) AS shown_from, least(30, n_texts) AS shown_to, n_texts - least(30, n_texts) AS remaining FROM n")
def search_summary(spark, sf):
    return reports.search_summary(search.found_in(works(spark, sf), PHRASE), 20, 10)


@query("SELECT p_partkey FROM part WHERE regexp_matches(lower(p_name), '(^|[^\\p{L}\\p{N}])ring[^\\p{L}\\p{N}]+of([^\\p{L}\\p{N}]|$)') OR regexp_matches(lower(p_name), '(^|[^\\p{L}\\p{N}])ring([^\\p{L}\\p{N}]|$)')")
def title_search(spark, sf):
    """Words of titles, found like those of lines."""
    return search.matches(table(spark, sf, "part"), "Ring", column="p_name").select("p_partkey")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 1 AND source = 'src1' AND contains(lower(lang || ' ' || source || ' ' || text), 'the')")
def report_filter(spark, sf):
    d = table(spark, sf, "documents")
    verdict = F.concat(F.element_at(F.array(F.lit("missing"), F.lit("diff"), F.lit("ok")), (F.col("doc_id") % 3 + 1).cast("int")), F.lit(":"), "lang")
    rows = d.select("doc_id", verdict.alias("verdict"), F.col("source").alias("collection"), "lang", "source", "text")
    return reports.report_filter(rows, "diff", "src1", "THE", ("lang", "source", "text")).select("doc_id")


@query("SELECT l_orderkey, l_linenumber, o_orderkey IS NOT NULL AS kept FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT') ON l_orderkey = o_orderkey")
def kept_and_gone(spark, sf):
    there = table(spark, sf, "orders").where("o_orderpriority <> '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return reports.split_kept(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), there, ["l_orderkey"])


@query("SELECT count(*) AS total, count(*) FILTER (o_orderpriority = '5-LOW') AS added, count(*) FILTER (o_totalprice > 100000) AS edited, count(*) FILTER (o_orderstatus = 'F') AS checked, count(*) FILTER (o_orderstatus <> 'F') AS remaining FROM orders")
def store_status(spark, sf):
    return reports.status_line(table(spark, sf, "orders"), F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") > 100000, F.col("o_orderstatus") == "F")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang WHEN doc_id % 4 = 1 THEN source ELSE 'col' END AS title, CASE WHEN doc_id % 4 = 0 THEN 'detail' WHEN doc_id % 4 = 1 THEN 'list' ELSE 'report' END AS title_from FROM documents")
def source_priority(spark, sf):
    """A field from the detail page, else the list page, else the report."""
    k = F.col("doc_id") % 4
    detail, listed = F.when(k == 0, F.col("lang")).when(k == 2, " "), F.when(k <= 1, F.col("source")).when(k == 3, "")
    return table(spark, sf, "documents").select("doc_id", *reports.first_source({"title": [("detail", detail), ("list", listed), ("report", F.lit("col"))]}))


@query("SELECT doc_id, CASE WHEN doc_id % 3 < 2 AND doc_id % 5 > 0 THEN source ELSE lang END AS value FROM documents")
def rule_gated_apply(spark, sf):
    """Rules that are on apply; an empty new value never does."""
    rule = F.element_at(F.array(F.lit("missing"), F.lit("author"), F.lit("title")), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = table(spark, sf, "documents").select("doc_id", rule.alias("rule"), F.col("lang").alias("old"), F.when(F.col("doc_id") % 5 > 0, F.col("source")).otherwise("").alias("new"))
    return reports.gated(rows, ("missing", "author")).select("doc_id", "value")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE source END AS notes, CAST(NULL AS VARCHAR) AS genre FROM documents")
def adapted_columns(spark, sf):
    """Columns by any of the names they have had; one that no version has is null."""
    rows = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("").alias("note_text"), "source")
    return reports.adapted(rows, {"notes": ("notes", "note_text", "source"), "genre": ("genre_id",)}).select("doc_id", "notes", "genre")
