"""Sources, upserts, keys, audits and copies over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.operators import maintain as mt
from matchlake.plans.checks import check
from matchlake.plans.tables import Tables
from matchlake.sources.documents import split_documents
from matchlake.sources.people import clean_people
from matchlake.sources.snapshots import rebuild, restore, snapshot


@check("src_json_dir", """
WITH raw AS (SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 1, 5) ELSE props END AS document FROM events)
SELECT event_id AS id, json_valid(document) AS readable,
       CASE WHEN json_valid(document) THEN CAST(json_extract_string(document, '$.k') AS BIGINT) END AS k
FROM raw""")
def _(t: Tables):
    text = F.when(F.col("event_type") == "error", F.substring("props", 1, 5)).otherwise(F.col("props"))
    good, bad = split_documents(t.events.select(F.col("event_id").alias("id"), text.alias("document")))
    k = F.variant_get(F.parse_json("document"), "$.k", "bigint")
    return good.select("id", F.lit(True).alias("readable"), k.alias("k")).unionByName(
        bad.select("id", F.lit(False).alias("readable"), F.lit(None).cast("long").alias("k"))
    )


@check("src_people_csv", """
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name END AS identifier, nullif(c_mktsegment, 'BUILDING') AS name,
       c_nationkey
FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def _(t: Tables):
    blank = F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_name"))
    name = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return clean_people(t.customer.select(blank.alias("identifier"), name.alias("name"), "c_nationkey"))


@check("upsert_overwrite", """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer
UNION ALL SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier""")
def _(t: Tables):
    changed = t.customer.where("c_acctbal < 0").select(
        "c_custkey", "c_name", "c_nationkey", F.lit(0.0).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"),
    )
    added = t.supplier.select(
        (F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return mt.upsert(t.customer, changed.unionByName(added), ["c_custkey"], "overwrite")


@check("upsert_ignore", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
UNION ALL SELECT DISTINCT 100 + p_size, 'SIZE', 0 FROM part""")
def _(t: Tables):
    known = t.nation.select("n_nationkey", F.lit("CHANGED").alias("n_name"), F.lit(9).alias("n_regionkey"))
    sizes = t.part.select(
        (100 + F.col("p_size")).alias("n_nationkey"), F.lit("SIZE").alias("n_name"), F.lit(0).alias("n_regionkey")
    ).distinct()
    return mt.upsert(t.nation, known.unionByName(sizes), ["n_nationkey"], "ignore")


@check("upsert_coalesce", """
SELECT s_suppkey, s_name, CASE WHEN s_acctbal < 5000 THEN -1 ELSE s_nationkey END AS s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT c_custkey + 1000000000, NULL, c_nationkey, NULL FROM customer""")
def _(t: Tables):
    patches = t.supplier.select(
        "s_suppkey", F.lit(None).cast("string").alias("s_name"),
        F.when(F.col("s_acctbal") < 5000, -1).alias("s_nationkey"),
    ).unionByName(
        t.customer.select(
            (F.col("c_custkey") + 1000000000).alias("s_suppkey"), F.lit(None).cast("string").alias("s_name"),
            F.col("c_nationkey").alias("s_nationkey"),
        )
    )
    return mt.upsert(t.supplier, patches, ["s_suppkey"], "coalesce")


_LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
]


@check("dedupe_last", f"""
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(c + ' DESC' for c in _LINE_ORDER)}) AS place FROM lineitem) WHERE place = 1""")
def _(t: Tables):
    return mt.dedupe(t.lineitem, ["l_orderkey", "l_linenumber"], _LINE_ORDER, "last")


@check("surrogate_key", """
WITH old AS (SELECT p_brand, row_number() OVER (ORDER BY substr(md5(p_brand), 1, 3), p_brand) AS brand_id
             FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand < 'Brand#2'))
SELECT * FROM old UNION ALL
SELECT p_brand, (SELECT max(brand_id) FROM old) + row_number() OVER (ORDER BY substr(md5(p_brand), 1, 3), p_brand)
FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand >= 'Brand#2')""")
def _(t: Tables):
    first_load = mt.assign_key(t.part.where("p_brand < 'Brand#2'"), ["p_brand"], "brand_id")
    return mt.assign_key(t.part, ["p_brand"], "brand_id", first_load)


@check("key_lookup", """
SELECT n_nationkey, n_name, n_regionkey, r_regionkey AS region_id FROM nation
LEFT JOIN region ON r_name = CASE WHEN n_regionkey = 3 THEN 'NOWHERE' ELSE
  (SELECT r_name FROM region WHERE r_regionkey = n_regionkey) END""")
def _(t: Tables):
    names = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region_name"))
    asked = t.nation.join(names, "n_regionkey").withColumn(
        "region_name", F.when(F.col("n_regionkey") == 3, "NOWHERE").otherwise(F.col("region_name"))
    )
    found = mt.attach_key(asked, t.region, {"region_name": "r_name"}, "r_regionkey", "region_id")
    return found.select("n_nationkey", "n_name", "n_regionkey", "region_id")


@check("audit_constraints", """
SELECT 'unique l_orderkey,l_linenumber' AS rule, 'lineitem' AS table_name, l_orderkey || '|' || l_linenumber AS key,
       count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'in documents', 'orders', CAST(o_custkey AS VARCHAR), count(*) FROM orders
WHERE o_custkey NOT IN (SELECT doc_id FROM documents) GROUP BY o_custkey
UNION ALL SELECT 'check discount', 'lineitem', NULL, count(*) FROM lineitem WHERE NOT l_discount < 0.1 HAVING count(*) > 0
UNION ALL SELECT 'not null l_tax', 'lineitem', NULL, count(*) FROM lineitem WHERE l_tax IS NULL HAVING count(*) > 0""")
def _(t: Tables):
    tables = {name: t.read(name) for name in ["lineitem", "orders", "documents", "part"]}
    rules = [
        mt.Unique("lineitem", ("l_orderkey", "l_linenumber")), mt.Unique("part", ("p_partkey",)),
        mt.ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
        mt.ForeignKey("orders", ("o_custkey",), "documents", ("doc_id",)),
        mt.NotNull("lineitem", "l_tax"), mt.Check("lineitem", "discount", "l_discount < 0.1"),
    ]
    return mt.audit(tables, rules)


@check("quarantine_bad_matches", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'ECONOMY')""")
def _(t: Tables):
    known = t.part.where("p_type <> 'ECONOMY'").select(F.col("p_partkey").alias("l_partkey"))
    orphans = t.lineitem.join(known, "l_partkey", "left_anti")
    return mt.drop_whole(t.lineitem, orphans, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey")


@check("apply_corrections", """
SELECT p_partkey, p_name, CASE WHEN p_size = 7 THEN 'Brand#FIX' ELSE p_brand END AS p_brand, p_type, p_size,
       CASE WHEN p_size = 9 THEN 1.5 ELSE p_retailprice END AS p_retailprice FROM part""")
def _(t: Tables):
    patches = t.part.where("p_size IN (7, 9)").select(
        "p_partkey", F.when(F.col("p_size") == 7, "Brand#FIX").alias("p_brand"),
        F.when(F.col("p_size") == 9, 1.5).alias("p_retailprice"),
    )
    return mt.apply_corrections(t.part, patches, "p_partkey")


@check("full_refresh", """
SELECT 'brands' AS table_name, count(DISTINCT p_brand) AS n, CAST(sum(DISTINCT length(p_brand)) AS BIGINT) AS checksum FROM part
UNION ALL SELECT 'teams', count(*), CAST(sum(DISTINCT length(n_name)) AS BIGINT) FROM nation""")
def _(t: Tables):
    folder = t.scratch()
    tables = {
        "brands": mt.assign_key(t.part.select(F.col("p_brand").alias("name")), ["name"], "id"),
        "teams": mt.assign_key(t.nation.select(F.col("n_name").alias("name")), ["name"], "id"),
        "players": t.customer,
    }
    rebuild(tables, folder)
    written = rebuild(tables, folder)
    counts = [
        t.spark.read.parquet(f"{folder}/{name}").agg(
            F.count(F.lit(1)).alias("n"), F.sum_distinct(F.length("name")).alias("checksum")
        ).select(F.lit(name).alias("table_name"), "n", "checksum")
        for name in written
    ]
    return counts[0].unionByName(counts[1])


@check("snapshot_restore", "SELECT * FROM customer")
def _(t: Tables):
    folder = t.scratch()
    path = snapshot(t.customer, folder, "customer")
    return restore(t.spark, path, f"{folder}/customer")
