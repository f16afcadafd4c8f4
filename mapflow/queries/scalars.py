"""Scalar functions, one query per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.queries.registry import query
from mapflow.sources.tables import Tables


@query(
    "scalar_string",
    """SELECT p_partkey, substr(p_name, 1, length(p_name) - 3) AS cut, substr(p_brand, 7) AS tail, substr(p_name, -4, 4) AS last4,
         right(p_type, 2) AS right2, upper(trim('  ' || p_name || ' ')) AS up, ltrim('   ' || p_type) AS lt,
         ltrim(lpad(cast(p_size AS varchar), 6, '0'), '0') AS no_zeros, lpad(cast(p_size AS varchar), 5, '0') AS padded,
         p_brand || '/' || p_type AS glued,
         array_to_string([p_brand, nullif(p_type, 'PROMO'), p_name], '-') AS with_sep, p_type || '|' || p_name AS piped,
         instr(p_name, ' ') AS blank_at, lower(p_type) AS low, regexp_replace(p_name, '[aeiou]', '_', 'g') AS masked
       FROM part""",
)
def scalar_string(spark: SparkSession, t: Tables) -> DataFrame:
    return t("part").selectExpr(
        "p_partkey",
        "substr(p_name, 1, length(p_name) - 3) AS cut",
        "substr(p_brand, 7) AS tail",
        "substr(p_name, -4, 4) AS last4",
        "right(p_type, 2) AS right2",
        "upper(trim(concat('  ', p_name, ' '))) AS up",
        "ltrim(concat('   ', p_type)) AS lt",
        "ltrim('0', lpad(cast(p_size as string), 6, '0')) AS no_zeros",
        "lpad(cast(p_size as string), 5, '0') AS padded",
        "concat(p_brand, '/', p_type) AS glued",
        "concat_ws('-', p_brand, nullif(p_type, 'PROMO'), p_name) AS with_sep",
        "p_type || '|' || p_name AS piped",
        "cast(instr(p_name, ' ') as bigint) AS blank_at",
        "lower(p_type) AS low",
        "regexp_replace(p_name, '[aeiou]', '_') AS masked",
    )


@query(
    "scalar_date",
    """WITH d AS (SELECT o_orderkey, cast(o_orderdate AS date) AS d, DATE '1998-08-31' AS r FROM orders)
       SELECT o_orderkey, cast(d + INTERVAL 12 MONTH AS date)::varchar AS plus_year, cast(d + 1 AS date)::varchar AS next_day,
         cast(d + INTERVAL 3 MONTH AS date)::varchar AS plus_quarter, cast(d + INTERVAL 10 DAY AS date)::varchar AS plus_ten,
         cast(d + INTERVAL 2 YEAR AS date)::varchar AS plus_two_years,
         date_diff('day', d, r) AS days_to, last_day(d)::varchar AS month_end, quarter(d) AS quarter,
         strftime(d, '%Y%m') AS month_text, strptime(strftime(d, '%Y%m%d'), '%Y%m%d')::date::varchar AS reparsed,
         CASE WHEN day(d) = day(r) OR d = last_day(d) THEN cast((year(r) - year(d)) * 12 + month(r) - month(d) AS double)
              ELSE cast((year(r) - year(d)) * 12 + month(r) - month(d) AS double) + (day(r) - day(d)) / 31.0::double END > 24 AS older_than_24,
         cast(epoch(r::timestamp) - epoch(d::timestamp) AS bigint) AS seconds_to
       FROM d""",
)
def scalar_date(spark: SparkSession, t: Tables) -> DataFrame:
    dated = t("orders").selectExpr(
        "o_orderkey", "cast(o_orderdate as date) AS d", "date('1998-08-31') AS r"
    )
    return dated.selectExpr(
        "o_orderkey",
        "cast(cast(dateadd(month, 12, d) as date) as string) AS plus_year",
        "cast(d + 1 as string) AS next_day",
        "cast(add_months(d, 3) as string) AS plus_quarter",
        "cast(cast(dateadd(day, 10, d) as date) as string) AS plus_ten",
        "cast(cast(dateadd(year, 2, d) as date) as string) AS plus_two_years",
        "cast(date_diff(day, d, r) as bigint) AS days_to",
        "cast(last_day(d) as string) AS month_end",
        "cast(quarter(d) as bigint) AS quarter",
        "date_format(d, 'yyyyMM') AS month_text",
        "cast(to_date(date_format(d, 'yyyyMMdd'), 'yyyyMMdd') as string) AS reparsed",
        "months_between(r, d) > 24 AS older_than_24",
        "unix_timestamp(to_timestamp(r)) - unix_timestamp(to_timestamp(d)) AS seconds_to",
    )


@query(
    "scalar_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_tax, 0) AS per_tax, round(l_quantity / 4, 1) AS rounded,
              l_quantity + l_linenumber * 2 - 1 AS mixed, least(l_quantity, 10.0, l_linenumber) AS low,
              greatest(l_quantity, 20.0, l_linenumber) AS high, abs(l_quantity - 25) AS distance FROM lineitem""",
)
def scalar_math(spark: SparkSession, t: Tables) -> DataFrame:
    return t("lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "try_divide(l_extendedprice, l_tax) AS per_tax",
        "round(l_quantity / 4, 1) AS rounded",
        "l_quantity + l_linenumber * 2 - 1 AS mixed",
        "least(l_quantity, 10.0d, l_linenumber) AS low",
        "greatest(l_quantity, 20.0d, l_linenumber) AS high",
        "abs(l_quantity - 25) AS distance",
    )


@query(
    "scalar_conditional",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'A' WHEN o_totalprice > 200000 THEN 'B' ELSE 'C' END AS searched,
         CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END AS simple,
         CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice > 100000 THEN 'F+' ELSE 'F-' END ELSE 'x' END AS nested,
         coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'), 'none') AS first_known,
         (o_orderstatus = substr(o_orderpriority, 3, 1)) = (o_orderpriority = '5-LOW') AS chained
       FROM orders""",
)
def scalar_conditional(spark: SparkSession, t: Tables) -> DataFrame:
    return t("orders").selectExpr(
        "o_orderkey",
        "case when o_totalprice > 400000 then 'A' when o_totalprice > 200000 then 'B' else 'C' end AS searched",
        "case o_orderstatus when 'F' then 'final' when 'O' then 'open' end AS simple",
        "case when o_orderstatus = 'F' then case when o_totalprice > 100000 then 'F+' else 'F-' end else 'x' end AS nested",
        "coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'), 'none') AS first_known",
        "o_orderstatus = substr(o_orderpriority, 3, 1) = (o_orderpriority = '5-LOW') AS chained",
    )


@query(
    "scalar_cast",
    """SELECT o_orderkey, cast(o_orderkey AS varchar) AS as_text, cast(cast(o_orderdate AS date) AS varchar) AS as_date,
         cast(cast(o_custkey AS varchar) AS double) AS as_double, try_cast(substr(o_orderpriority, 1, 1) AS integer) AS as_int,
         try_cast(o_orderpriority AS integer) IS NULL AS not_a_number,
         cast(cast(o_totalprice AS decimal(38,2)) AS varchar) AS as_decimal FROM orders""",
)
def scalar_cast(spark: SparkSession, t: Tables) -> DataFrame:
    return t("orders").selectExpr(
        "o_orderkey",
        "cast(o_orderkey as string) AS as_text",
        "cast(cast(o_orderdate as date) as string) AS as_date",
        "cast(cast(o_custkey as string) as double) AS as_double",
        "try_cast(substr(o_orderpriority, 1, 1) as integer) AS as_int",
        "try_cast(o_orderpriority as integer) is null AS not_a_number",
        "cast(cast(o_totalprice as decimal(38,2)) as string) AS as_decimal",
    )


@query(
    "scalar_array",
    """SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_priorities,
              min(array_to_string([o_orderstatus, nullif(o_orderpriority, '5-LOW'), cast(o_orderkey AS varchar)], '_')) AS smallest_name
       FROM orders GROUP BY 1""",
)
def scalar_array(spark: SparkSession, t: Tables) -> DataFrame:
    """The collected set has at most as many members as there are priorities."""
    name = "array_join(array(o_orderstatus, nullif(o_orderpriority, '5-LOW'), cast(o_orderkey as string)), '_')"
    return t("orders").groupBy("o_custkey").agg(
        F.size(F.collect_set("o_orderpriority")).cast("bigint").alias("n_priorities"),
        F.min(F.expr(name)).alias("smallest_name"),
    )
