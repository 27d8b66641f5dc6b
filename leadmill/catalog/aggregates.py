"""Queries on grouping, totals, pivots and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadmill.catalog.registry import QUERIES, query, read, source, with_source
from leadmill.operators import aggregate as A, pivot as P
from leadmill.operators.median import exact_median

# gaps, zeros, missing keys and one group without any value
LINES = """
SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS flag,
       l_linestatus AS status,
       l_orderkey, l_linenumber, l_shipdate,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
            WHEN l_orderkey % 5 = 0 THEN 0.0 ELSE l_quantity END AS quantity,
       nullif(l_partkey % 50, 3) AS part,
       l_extendedprice AS price, l_discount AS discount
FROM {lineitem}
"""
ORDERS = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority AS priority, o.o_orderstatus AS status,
       c.c_mktsegment AS segment, o.o_totalprice AS price
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUSES = ["F", "O", "P"]
KEYS = ["flag", "status"]


def grouped(select: str, where: str = "flag IS NOT NULL") -> str:
    return with_source(LINES, f"SELECT flag, status, {select} FROM src WHERE {where} GROUP BY flag, status")


@query("a0_group_rules", grouped("round_even(avg(nullif(discount, 0)) * 1.0, 0) AS discount"))
def a0(spark, folder):
    return A.group_data(source(spark, folder, LINES), KEYS, "discount", "mean", "discount")


@query("a1_group_count", grouped("count(*) AS lines"))
def a1(spark, folder):
    return A.group_data(source(spark, folder, LINES), KEYS, "lines")


@query("a2_group_sum", grouped("coalesce(round_even(sum(nullif(quantity, 0)), 0), 0) AS quantity"))
def a2(spark, folder):
    return A.group_data(source(spark, folder, LINES), KEYS, "quantity", "sum", "quantity")


@query("a3_group_unique", grouped("count(DISTINCT nullif(part, 0)) AS parts"))
def a3(spark, folder):
    return A.group_data(source(spark, folder, LINES), KEYS, "parts", "unique", "part")


@query("a4_group_mean", grouped("round_even(avg(nullif(quantity, 0)), 0) AS quantity"))
def a4(spark, folder):
    return A.group_data(source(spark, folder, LINES), KEYS, "quantity", "mean", "quantity")


@query("a5_group_median", grouped("round_even(median(nullif(price, 0)), 0) AS price"))
def a5(spark, folder):
    return A.group_data(source(spark, folder, LINES), KEYS, "price", "median", "price")


@query("a5_group_median_large", QUERIES["a5_group_median"].sql)
def a5_large(spark, folder):
    lines = A.not_null(source(spark, folder, LINES), KEYS)
    return A.round_numbers(exact_median(lines, KEYS, F.expr("nullif(price, 0)"), "price", large_rows=1000))


@query(
    "a6_group_agg",
    grouped(
        "coalesce(round_even(sum(nullif(quantity, 0)), 0), 0) AS total_quantity, "
        "round_even(avg(nullif(price, 0)), 0) AS mean_price, "
        "round_even(median(nullif(discount, 0)), 0) AS middle_discount, "
        "count(DISTINCT nullif(part, 0)) AS parts"
    ),
)
def a6(spark, folder):
    functions = {"quantity": "sum", "price": "mean", "discount": "median", "part": "nunique"}
    names = {"quantity": "total_quantity", "price": "mean_price", "discount": "middle_discount", "part": "parts"}
    return A.group_data(source(spark, folder, LINES), KEYS, names, "agg", functions)


@query(
    "a7_naming_policy",
    grouped(
        'round_even(avg(nullif(price, 0)), 0) AS "Avg_price", '
        'coalesce(round_even(sum(nullif(quantity, 0)), 0), 0) AS "Sum_quantity", '
        'count(nullif(part, 0)) AS "#_part", round_even(max(nullif(discount, 0)), 0) AS "max_discount"'
    ),
)
def a7(spark, folder):
    functions, names = A.create_names(["price", "quantity", "part", "discount"], ["mean", "sum", "count", "max"])
    return A.group_data(source(spark, folder, LINES), KEYS, names, "agg", functions)


@query("a8_group_filled_mean", grouped("CAST(round_even(coalesce(avg(nullif(quantity, 0)), 0), 0) AS BIGINT) AS quantity"))
def a8_mean(spark, folder):
    return A.group_data_filled(source(spark, folder, LINES), KEYS, "quantity", "mean", "quantity")


@query("a8_group_filled_median", grouped("round_even(coalesce(median(nullif(quantity, 0)), 0) * 100, 0) / 100 AS quantity"))
def a8_median(spark, folder):
    return A.group_data_filled(source(spark, folder, LINES), KEYS, "quantity", "median", "quantity")


@query(
    "a8_group_filled_totals",
    with_source(
        LINES,
        ", g AS (SELECT flag, coalesce(round_even(sum(nullif(quantity, 0)), 0), 0) AS quantity "
        "FROM src WHERE flag IS NOT NULL GROUP BY flag) "
        'SELECT flag, quantity, quantity AS "RowTotal" FROM g '
        "UNION ALL SELECT 'Grand Total', sum(quantity), sum(quantity) FROM g",
    ),
)
def a8_totals(spark, folder):
    return A.group_data_filled(
        source(spark, folder, LINES), "flag", "quantity", "sum", "quantity", row_total=True, col_total=True
    )


@query(
    "a9_totals",
    with_source(
        LINES,
        ", g AS (SELECT flag, status, coalesce(round_even(sum(nullif(quantity, 0)), 0), 0) AS quantity, "
        "count(DISTINCT nullif(part, 0)) AS parts FROM src WHERE flag IS NOT NULL GROUP BY flag, status) "
        'SELECT flag, status, quantity, parts, quantity + parts AS "RowTotal" FROM g '
        "UNION ALL SELECT 'Total', 'Total', sum(quantity), CAST(sum(parts) AS BIGINT), sum(quantity + parts) FROM g",
    ),
)
def a9(spark, folder):
    return A.group_data(
        source(spark, folder, LINES), KEYS, {"part": "parts"}, "agg", {"quantity": "sum", "part": "nunique"},
        row_total=True, col_total=True,
    )


def cells(expression: str, column: str, values: list[str]) -> str:
    return ", ".join(
        f"CAST(round_even(coalesce({expression.format(here=f'''FILTER (WHERE {column} = '{v}')''')}, 0), 0) AS BIGINT)"
        f' AS "{v}"'
        for v in values
    )


@query(
    "a10_pivot",
    with_source(ORDERS, f"SELECT priority, {cells('sum(price) {here}', 'status', STATUSES)} FROM src GROUP BY priority"),
)
def a10(spark, folder):
    return P.pivot_data(source(spark, folder, ORDERS), "priority", "status", "price")


@query(
    "a11_pivot_group",
    with_source(
        ORDERS,
        ", d AS (SELECT DISTINCT o_custkey, priority, segment FROM src), "
        f"g AS (SELECT priority, {cells('count(*) {here}', 'segment', SEGMENTS)} FROM d GROUP BY priority), "
        f"""t AS (SELECT *, {' + '.join(f'"{s}"' for s in SEGMENTS)} AS "RowTotal" FROM g) """
        "SELECT * FROM t UNION ALL SELECT 'Total', "
        + ", ".join(f'CAST(sum("{c}") AS BIGINT)' for c in [*SEGMENTS, "RowTotal"]) + " FROM t",
    ),
)
def a11(spark, folder):
    return P.pivot_group_data(
        source(spark, folder, ORDERS), ["priority"], ["segment"], "customers", drop_columns=["o_custkey"],
        row_total=True, col_total=True,
    )


@query(
    "a11_pivot_group_measures",
    with_source(
        ORDERS,
        ", g AS (SELECT priority, status, round_even(avg(nullif(price, 0)), 0) AS mean_price, "
        "count(DISTINCT nullif(o_custkey, 0)) AS customers FROM src GROUP BY ALL) SELECT priority, "
        + ", ".join(
            f"CAST(round_even(coalesce(sum({m}) FILTER (WHERE status = '{s}'), 0), 0) AS BIGINT) AS \"{m}_{s}\""
            for m in ("mean_price", "customers") for s in STATUSES
        )
        + " FROM g GROUP BY priority",
    ),
)
def a11_measures(spark, folder):
    return P.pivot_group_data(
        source(spark, folder, ORDERS), ["priority"], ["status"],
        {"price": "mean_price", "o_custkey": "customers"}, "agg", {"price": "mean", "o_custkey": "nunique"},
    )


@query(
    "a12_averages",
    with_source(
        LINES,
        "SELECT flag, round_even(avg(CASE WHEN quantity > 0 THEN quantity END), 0) AS \"Avg_quantity\", "
        "round_even(avg(CASE WHEN price > 0 THEN price END), 0) AS \"Avg_price\" FROM src "
        "WHERE flag IS NOT NULL GROUP BY flag HAVING count(*) FILTER (WHERE quantity > 0) > 0",
    ),
)
def a12(spark, folder):
    return A.calculate_averages(source(spark, folder, LINES), ["quantity", "price"], "flag")


@query(
    "a12_averages_whole",
    with_source(
        LINES,
        "SELECT 'Average' AS \"Average_type\", "
        "CAST(round_even(avg(CASE WHEN quantity > 0 THEN quantity END), 0) AS BIGINT) AS \"Avg_quantity\", "
        "CAST(round_even(avg(CASE WHEN price > 0 THEN price END), 0) AS BIGINT) AS \"Avg_price\" FROM src",
    ),
)
def a12_whole(spark, folder):
    return A.calculate_averages(source(spark, folder, LINES), ["quantity", "price"])


@query("a13_value_count", with_source(LINES, 'SELECT flag, count(*) AS "Count" FROM src WHERE flag IS NOT NULL GROUP BY flag'))
def a13(spark, folder):
    return A.value_count(source(spark, folder, LINES), "flag")


@query(
    "a14_summary",
    """
    SELECT 'columns' AS metric, '' AS "column", 6.0::DOUBLE AS value
    UNION ALL SELECT 'rows', '', count(*) FROM orders
    UNION ALL SELECT 'unique', 'o_custkey', count(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'unique', 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
    """,
)
def a14(spark, folder):
    return A.summary(read(spark, folder, "orders"), ["o_custkey", "o_orderstatus"])


@query(
    "a15_description",
    with_source(
        LINES,
        """
        SELECT 'columns' AS metric, '' AS "column", 9.0::DOUBLE AS value
        UNION ALL SELECT 'rows', '', count(*) FROM src
        UNION ALL SELECT 'mean', 'quantity', round(avg(quantity), 6) FROM src
        UNION ALL SELECT 'count', 'flag', count(flag) FROM src
        UNION ALL SELECT 'unique', 'part', count(DISTINCT part) FROM src
        UNION ALL SELECT 'unsupported mode', 'status', NULL
        """,
    ),
)
def a15(spark, folder):
    told = A.describe(
        source(spark, folder, LINES), {"quantity": "mean", "flag": "count", "part": "unique", "status": "mode"}
    )
    return told.withColumn("value", F.round("value", 6))


@query(
    "o6_top_row_per_group",
    with_source(
        LINES,
        "SELECT flag, status, l_orderkey, l_linenumber, round_even(quantity, 0) AS quantity, "
        "round_even(price, 0) AS price FROM (SELECT *, row_number() OVER "
        "(PARTITION BY flag, status ORDER BY nullif(price, 0) DESC NULLS LAST, l_orderkey, l_linenumber) AS place "
        "FROM src WHERE flag IS NOT NULL) WHERE place = 1",
    ),
)
def o6(spark, folder):
    top = A.group_data(
        source(spark, folder, LINES), KEYS, "price", "maxid", "price", order_by=[F.col("l_orderkey"), F.col("l_linenumber")]
    )
    return top.select("flag", "status", "l_orderkey", "l_linenumber", "quantity", "price")
