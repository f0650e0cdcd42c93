"""The registered queries of the query layer, each with its SQL equivalent.

Tables without nulls get derived columns, the same in both languages: ``prio`` of
``orders`` is null for one priority, ``part`` has a parent and a set of numbers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import Clock
from ..functions.expr import choose, text
from ..operators.query import Query
from ..sources.catalog import Catalog, Context, Entity

NOW = dt.datetime(2000, 6, 15, 10, 30)
EVENT_NOW = dt.datetime(2024, 1, 20, 12, 0)
_SEGMENTS = {0: "zeta", 1: "alpha", 2: "kappa", 3: "beta", 4: "omega"}


def catalog(spark: SparkSession, sf_dir: str, now: dt.datetime = NOW) -> Catalog:
    def table(name):
        return f"{sf_dir}/{name}.parquet"

    def orders(s):
        df = s.read.parquet(table("orders"))
        return df.withColumn("prio", F.nullif("o_orderpriority", F.lit("5-LOW"))).withColumn("due", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))

    def part(s):
        df = s.read.parquet(table("part"))
        up = F.floor(F.col("p_partkey") / 10).cast("long")
        return df.withColumn("p_parent", F.when(up != F.col("p_partkey"), up)).withColumn("p_tags", F.array_distinct(F.array(F.col("p_size") % 3, F.col("p_size") % 5)))

    def users(s):
        df = s.read.parquet(table("customer")).select(F.col("c_nationkey").cast("long").alias("id")).distinct()
        return df.select("id", F.when(F.col("id") > 0, F.floor(F.col("id") / 3).cast("long")).alias("manager"))

    def teams(s):
        df = s.read.parquet(table("supplier")).select(F.col("s_nationkey").cast("long").alias("member")).distinct()
        return df.select((F.col("member") + 20).alias("team"), "member")

    entities = [
        Entity("orders", orders, "o_orderkey", retained=table("orders")),
        Entity("part", part, "p_partkey", "p_parent", {"p_size": {i: f"{(i * 37) % 50:02d}" for i in range(1, 51)}}),
        *(Entity(n, table(n), k) for n, k in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("nation", "n_nationkey"), ("region", "r_regionkey"), ("events", "event_id"), ("lineitem", None))),
    ]
    return Catalog(spark, entities, Context(Clock(now), 3, 7, users, teams))


_O = "(SELECT *, nullif(o_orderpriority,'5-LOW') AS prio, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS due FROM orders)"
_P = "(SELECT *, CASE WHEN p_partkey // 10 <> p_partkey THEN p_partkey // 10 END AS p_parent, list_distinct([p_size % 3, p_size % 5]) AS p_tags FROM part)"
_U = "(SELECT DISTINCT c_nationkey::BIGINT AS id, CASE WHEN c_nationkey > 0 THEN (c_nationkey // 3)::BIGINT END AS manager FROM customer)"
_FLAGSHIP = """SELECT year(o_orderdate)::BIGINT AS order_year, count(*) AS orders, round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE, 2) AS revenue, round(avg(o_totalprice), 4) AS average
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment LIKE 'B%' AND o_orderstatus = 'F' GROUP BY 1"""

_found: dict[str, tuple[Callable, str | None]] = {}


def _add(name: str, build: Callable[[Catalog], Query | DataFrame], sql: str | None, now: dt.datetime = NOW) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        q = build(catalog(spark, sf_dir, now))
        return q.to_df() if isinstance(q, Query) else q

    run.__name__ = name
    _found[name] = (run, sql)


def _flagship(c: Catalog) -> Query:
    return (
        c.query("orders", alias="o")
        .join(c.query("customer", alias="c"), lambda r: r.o_custkey, lambda r: r.c_custkey)
        .where(lambda r: r.c.c_mktsegment.startswith("B") & (r.o.o_orderstatus == "F"))
        .group_by(lambda r: r.o.o_orderdate.year())
        .select(lambda g: {
            "order_year": g.key.apply(lambda x: x.cast("long")),
            "orders": g.count(),
            "revenue": g.sum(lambda r: r.o.o_totalprice.apply(lambda x: x.cast("decimal(18,2)"))).apply(lambda x: F.round(x.cast("double"), 2)),
            "average": g.average(lambda r: r.o.o_totalprice).apply(lambda x: F.round(x, 4)),
        })
        .order_by(lambda r: r.order_year)
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagship(catalog(spark, sf_dir)).to_df()


def _orders(name: str, pred: Callable, sql: str) -> None:
    """A condition on orders: the keys of the rows that it keeps."""
    _add(name, lambda c: c.query("orders").where(pred).select(lambda r: {"k": r.o_orderkey}), f"SELECT o_orderkey AS k FROM {_O} WHERE {sql}")


def _dates(name: str, method: str, args: tuple, sql: str, column: str = "due") -> None:
    def pred(r):
        return getattr(r[column], method)(*args)

    _orders(name, pred, sql)


def _define() -> None:
    ts = lambda s: f"TIMESTAMP '{s}'"
    between = lambda a, b, c="due": f"{c} >= {ts(a)} AND {c} < {ts(b)}"
    _add("flagship_join_group", _flagship, _FLAGSHIP)
    # sources and projections
    _add("s1_typed_source", lambda c: c.query("region"), "SELECT * FROM region")
    _add("s3_column_set", lambda c: c.query("nation", "n_name"), "SELECT n_nationkey, n_name FROM nation")
    _add("s4_all_columns", lambda c: c.query("supplier"), "SELECT * FROM supplier")
    _add("s5_retained_source", lambda c: c.query("orders").with_datasource("retained").select(lambda r: {"k": r.o_orderkey}), "SELECT o_orderkey AS k FROM orders")
    _add("s7_dynamic_attribute", lambda c: c.query("nation").select(lambda r: {"v": r.attr("n_" + "name")}), "SELECT n_name AS v FROM nation")
    _add("p1_named_columns", lambda c: c.query("customer").select(lambda r: {"id": r.c_custkey, "seg": r.c_mktsegment}), "SELECT c_custkey AS id, c_mktsegment AS seg FROM customer")
    _add("p3_single_column", lambda c: c.query("customer").select(lambda r: r.c_name), "SELECT c_name FROM customer")
    nr = lambda c: c.query("nation", alias="n").join(c.query("region", alias="r"), lambda x: x.n_regionkey, lambda x: x.r_regionkey)
    _add("p4_whole_entity", lambda c: nr(c).select(lambda x: {"n": x.n.n_name, "region": x.r}).to_df().select("n", F.col("region.r_name").alias("rn"), F.col("region.r_regionkey").alias("rk")), "SELECT n_name AS n, r_name AS rn, r_regionkey AS rk FROM nation JOIN region ON n_regionkey = r_regionkey")
    _add("p5_nested", lambda c: c.query("nation").select(lambda x: {"a": {"id": x.n_nationkey, "name": x.n_name}}).to_df().select("a.id", "a.name"), "SELECT n_nationkey AS id, n_name AS name FROM nation")
    _add("p6_join_projection", lambda c: nr(c).select(lambda x: {"n": x.n.n_name, "r": x.r.r_name}), "SELECT n_name AS n, r_name AS r FROM nation JOIN region ON n_regionkey = r_regionkey")
    _add("p8_conditional", lambda c: c.query("customer").select(lambda r: {"id": r.c_custkey, "band": choose(r.c_acctbal > 0, "plus", "minus")}), "SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN 'plus' ELSE 'minus' END AS band FROM customer")
    _add("p9_coalesce", lambda c: c.query("orders").select(lambda r: {"k": r.o_orderkey, "p": r.prio.or_else("none")}), f"SELECT o_orderkey AS k, coalesce(prio, 'none') AS p FROM {_O}")
    _add("p10_computed", lambda c: c.query("nation").select(lambda r: {"t": text(r.n_name, "/", r.n_nationkey), "x": r.n_nationkey * 2 + 1, "u": r.n_name.apply(F.lower)}), "SELECT n_name || '/' || n_nationkey AS t, n_nationkey * 2 + 1 AS x, lower(n_name) AS u FROM nation")
    _add("p11_reprojection", lambda c: c.query("nation").select(lambda r: {"a": r.n_name, "b": r.n_regionkey}).select(lambda r: {"z": r.a}), "SELECT n_name AS z FROM nation")
    _add("p13_count_children", lambda c: c.query("part").select(lambda r: {"id": r.p_partkey, "n": r.count_children()}), f"SELECT p.p_partkey AS id, (SELECT count(*) FROM {_P} c WHERE c.p_parent = p.p_partkey) AS n FROM {_P} p")
    # conditions
    _orders("c1_eq", lambda r: r.prio == "1-URGENT", "prio = '1-URGENT'")
    _orders("c2_ne", lambda r: r.prio != "1-URGENT", "(prio <> '1-URGENT' OR prio IS NULL)")
    _orders("c3_comparisons", lambda r: (r.o_totalprice >= 1000) & (r.o_totalprice < 200000) & (r.o_orderkey > 5) & (r.o_custkey <= 900), "o_totalprice >= 1000 AND o_totalprice < 200000 AND o_orderkey > 5 AND o_custkey <= 900")
    _orders("c3_reversed_constant", lambda r: 100 > r.o_orderkey, "100 > o_orderkey")
    _orders("c4_negated_comparison", lambda r: ~(r.o_totalprice < 100000) & ~(r.prio == "2-HIGH"), "o_totalprice >= 100000 AND (prio <> '2-HIGH' OR prio IS NULL)")
    _orders("c5_null", lambda r: r.prio == None, "prio IS NULL")  # noqa: E711
    _orders("c5_not_null", lambda r: r.prio != None, "prio IS NOT NULL")  # noqa: E711
    _orders("c6_contains", lambda r: r.prio.contains("ED"), "prio LIKE '%ED%'")
    _orders("c6_contains_wildcard", lambda r: r.prio.contains("1_U"), "prio LIKE '%1_U%'")
    _orders("c7_startswith", lambda r: r.prio.startswith("1"), "prio LIKE '1%'")
    _orders("c8_endswith", lambda r: r.prio.endswith("H"), "prio LIKE '%H'")
    _orders("c9_not_like", lambda r: ~r.prio.contains("ED"), "(prio NOT LIKE '%ED%' OR prio IS NULL)")
    _orders("c10_null_or_empty", lambda r: r.prio.is_null_or_empty(), "(prio IS NULL OR prio = '')")
    _orders("c11_not_null_or_empty", lambda r: ~r.prio.is_null_or_empty(), "(prio IS NOT NULL AND prio <> '')")
    for n, (f, s) in {
        "c12_length_eq": (lambda r: r.prio.length() == 8, "length(prio) = 8"),
        "c13_length_ne": (lambda r: r.prio.length() != 8, "(length(prio) <> 8 OR prio IS NULL)"),
        "c14_length_gt": (lambda r: r.prio.length() > 7, "length(prio) > 7"),
        "c14_length_ge": (lambda r: r.prio.length() >= 8, "length(prio) >= 8"),
        "c15_length_lt": (lambda r: r.prio.length() < 8, "(length(prio) < 8 OR prio IS NULL)"),
        "c15_length_le": (lambda r: r.prio.length() <= 7, "(length(prio) <= 7 OR prio IS NULL)"),
        "c16_length_reversed": (lambda r: 8 >= r.prio.length(), "(length(prio) <= 8 OR prio IS NULL)"),
        "c17_in": (lambda r: r.prio.is_in(["1-URGENT", "2-HIGH"]), "prio IN ('1-URGENT','2-HIGH')"),
        "c18_not_in": (lambda r: ~r.prio.is_in(["1-URGENT", "2-HIGH"]), "(prio NOT IN ('1-URGENT','2-HIGH') OR prio IS NULL)"),
        "f2_and_or": (lambda r: (r.prio == "1-URGENT") | ((r.o_orderstatus == "F") & (r.o_totalprice > 300000)), "prio = '1-URGENT' OR (o_orderstatus = 'F' AND o_totalprice > 300000)"),
        "f3_de_morgan": (lambda r: ~((r.prio == "1-URGENT") | (r.o_totalprice > 300000)), "(prio <> '1-URGENT' OR prio IS NULL) AND o_totalprice <= 300000"),
        "f6_column_to_column": (lambda r: r.o_custkey > r.o_orderkey, "o_custkey > o_orderkey"),
        "f6_column_ne_column": (lambda r: r.prio != r.o_orderpriority, "(prio <> o_orderpriority OR prio IS NULL)"),
    }.items():
        _orders(n, f, s)
    _add("f1_chained_where", lambda c: c.query("orders").where(lambda r: (r.o_orderstatus == "F") | (r.o_orderstatus == "P")).where(lambda r: r.o_totalprice > 250000).select(lambda r: {"k": r.o_orderkey}), "SELECT o_orderkey AS k FROM orders WHERE (o_orderstatus = 'F' OR o_orderstatus = 'P') AND o_totalprice > 250000")
    parts = lambda n, f, s: _add(n, lambda c: c.query("part").where(f).select(lambda r: {"k": r.p_partkey}), f"SELECT p_partkey AS k FROM {_P} WHERE {s}")
    parts("c22_contains_value", lambda r: r.p_tags.contains_value(2), "list_contains(p_tags, 2)")
    parts("c23_contains_values", lambda r: r.p_tags.contains_values(2, 4), "list_has_any(p_tags, [2, 4])")
    parts("c24_not_contains_values", lambda r: ~r.p_tags.contains_values(2, 4), "NOT list_has_any(p_tags, [2, 4])")
    parts("c25_set_equals_one", lambda r: r.p_tags.set_equals(0), "list_sort(p_tags) = [0]")
    parts("c26_set_equals_many", lambda r: r.p_tags.set_equals(3, 1), "list_sort(p_tags) = [1, 3]")
    parts("c27_set_not_equal", lambda r: ~r.p_tags.set_equals(3, 1), "list_sort(p_tags) <> [1, 3]")
    # dates; the clock stands at 2000-06-15 10:30, a Thursday
    now = "2000-06-15 10:30:00"
    upto = lambda a: f"due >= {ts(a)} AND due <= {ts(now)}"
    after = lambda b: f"due > {ts(now)} AND due < {ts(b)}"
    for n, m, a, s in (
        ("d01", "last_seven_days", (), upto("2000-06-08")), ("d02", "last_fiscal_period", (), between("2000-01-01", "2000-04-01")),
        ("d03", "last_fiscal_year", (), between("1999-01-01", "2000-01-01")), ("d04", "last_month", (), between("2000-05-01", "2000-06-01")),
        ("d05", "last_week", (), between("2000-06-04", "2000-06-11")), ("d06", "last_year", (), between("1999-01-01", "2000-01-01")),
        ("d07", "last_x_days", (30,), upto("2000-05-16")), ("d08", "last_x_fiscal_periods", (2,), between("1999-10-01", "2000-04-01")),
        ("d09", "last_x_fiscal_years", (2,), between("1998-01-01", "2000-01-01")), ("d10", "last_x_hours", (100,), upto("2000-06-11 06:30:00")),
        ("d11", "last_x_months", (3,), upto("2000-03-15")), ("d12", "last_x_weeks", (3,), upto("2000-05-25")), ("d13", "last_x_years", (2,), upto("1998-06-15")),
        ("d14", "next_seven_days", (), after("2000-06-23")), ("d15", "next_fiscal_period", (), between("2000-07-01", "2000-10-01")),
        ("d16", "next_fiscal_year", (), between("2001-01-01", "2002-01-01")), ("d17", "next_month", (), between("2000-07-01", "2000-08-01")),
        ("d18", "next_week", (), between("2000-06-18", "2000-06-25")), ("d19", "next_year", (), between("2001-01-01", "2002-01-01")),
        ("d20", "next_x_days", (30,), after("2000-07-16")), ("d21", "next_x_fiscal_periods", (2,), between("2000-07-01", "2001-01-01")),
        ("d22", "next_x_fiscal_years", (1,), between("2001-01-01", "2002-01-01")), ("d23", "next_x_hours", (100,), f"due > {ts(now)} AND due <= {ts('2000-06-19 14:30:00')}"),
        ("d24", "next_x_months", (3,), after("2000-09-16")), ("d25", "next_x_weeks", (3,), after("2000-07-07")), ("d26", "next_x_years", (1,), after("2001-06-16")),
        ("d27", "in_fiscal_period", (2,), "quarter(due) = 2"), ("d28", "in_fiscal_period_and_year", (2, 1999), between("1999-04-01", "1999-07-01")),
        ("d29", "in_fiscal_year", (1999,), between("1999-01-01", "2000-01-01")), ("d30", "in_or_after_fiscal_period_and_year", (2, 1999), f"due >= {ts('1999-04-01')}"),
        ("d31", "in_or_before_fiscal_period_and_year", (2, 1999), f"due < {ts('1999-07-01')}"), ("d32", "older_than_x_months", (12,), f"due < {ts('1999-06-15 10:30:00')}"),
        ("d33", "on", (dt.datetime(1999, 5, 4),), between("1999-05-04", "1999-05-05")), ("d34", "on_or_after", (dt.datetime(1999, 5, 4),), f"due >= {ts('1999-05-04')}"),
        ("d35", "on_or_before", (dt.datetime(1999, 5, 4),), f"due < {ts('1999-05-05')}"), ("d36", "this_fiscal_period", (), between("2000-04-01", "2000-07-01")),
        ("d37", "this_fiscal_year", (), between("2000-01-01", "2001-01-01")), ("d38", "this_month", (), between("2000-06-01", "2000-07-01")),
        ("d39", "this_week", (), between("2000-06-11", "2000-06-18")), ("d40", "this_year", (), between("2000-01-01", "2001-01-01")),
        ("d41", "today", (), between("2000-06-15", "2000-06-16")), ("d42", "tomorrow", (), between("2000-06-16", "2000-06-17")), ("d43", "yesterday", (), between("2000-06-14", "2000-06-15")),
        ("d44", "between", (dt.datetime(1999, 1, 5), dt.datetime(1999, 3, 1)), f"due BETWEEN {ts('1999-01-05')} AND {ts('1999-03-01')}"),
        ("d45", "not_between", (dt.datetime(1999, 1, 5), dt.datetime(1999, 3, 1)), f"(due < {ts('1999-01-05')} OR due > {ts('1999-03-01')})"),
    ):
        _dates(f"{n}_{m}", m, a, s)
    _add("d10_last_x_hours_events", lambda c: c.query("events").where(lambda r: r.ts.last_x_hours(36)).select(lambda r: {"k": r.event_id}), f"SELECT event_id AS k FROM events WHERE ts >= {ts('2024-01-19 00:00:00')} AND ts <= {ts('2024-01-20 12:00:00')}", EVENT_NOW)
    # users and hierarchies
    who = lambda n, f, s: _add(n, lambda c: c.query("customer").where(f).select(lambda r: {"k": r.c_custkey}), f"SELECT c_custkey AS k FROM customer WHERE {s}")
    who("u1_eq_user", lambda r: r.c_nationkey.equal_user_id(), "c_nationkey = 3")
    who("u2_ne_user", lambda r: r.c_nationkey.not_equal_user_id(), "c_nationkey <> 3")
    who("u3_eq_business", lambda r: r.c_nationkey.equal_business_id(), "c_nationkey = 7")
    who("u4_ne_business", lambda r: ~r.c_nationkey.equal_business_id(), "c_nationkey <> 7")
    tree = f"WITH RECURSIVE h(id) AS (SELECT p_partkey FROM part WHERE p_partkey = {{v}} UNION SELECT {{to}} FROM {_P} p JOIN h ON {{on}})"
    down, up = tree.format(v=2, to="p.p_partkey", on="p.p_parent = h.id"), tree.format(v=1234, to="p.p_parent", on="p.p_partkey = h.id AND p.p_parent IS NOT NULL")
    for n, f, head, s in (
        ("h1_above", lambda r: r.p_partkey.above(1234), up, "p_partkey IN (SELECT id FROM h) AND p_partkey <> 1234"), ("h2_above_or_equal", lambda r: r.p_partkey.above_or_equal(1234), up, "p_partkey IN (SELECT id FROM h)"),
        ("h3_under", lambda r: r.p_partkey.under(2), down, "p_partkey IN (SELECT id FROM h) AND p_partkey <> 2"), ("h4_under_or_equal", lambda r: r.p_partkey.under_or_equal(2), down, "p_partkey IN (SELECT id FROM h)"),
        ("h5_not_under", lambda r: r.p_partkey.not_under(2), down, "(p_partkey NOT IN (SELECT id FROM h) OR p_partkey = 2)"),
        ("h3_under_in_or", lambda r: r.p_partkey.under(2) | (r.p_size == 7), down, "(p_partkey IN (SELECT id FROM h) AND p_partkey <> 2) OR p_size = 7"),
    ):
        _add(n, lambda c, f=f: c.query("part").where(f).select(lambda r: {"k": r.p_partkey}), f"{head} SELECT p_partkey AS k FROM part WHERE {s}")
    people = f"WITH RECURSIVE h(id) AS (SELECT 3::BIGINT UNION SELECT u.id FROM {_U} u JOIN h ON u.manager = h.id)"
    _add("h6_user_hierarchy", lambda c: c.query("customer").where(lambda r: r.c_nationkey.equal_user_or_hierarchy()).select(lambda r: {"k": r.c_custkey}), f"{people} SELECT c_custkey AS k FROM customer WHERE c_nationkey IN (SELECT id FROM h)")
    _add("h7_user_hierarchy_teams", lambda c: c.query("customer").where(lambda r: r.c_nationkey.equal_user_or_hierarchy_and_teams()).select(lambda r: {"k": r.c_custkey}), f"{people} SELECT c_custkey AS k FROM customer WHERE c_nationkey IN (SELECT id FROM h UNION SELECT s_nationkey + 20 FROM supplier WHERE s_nationkey IN (SELECT id FROM h))")
    # joins
    co = lambda c, how="join", kids=None: getattr(c.query("customer", alias="c"), how)(kids or c.query("orders", alias="o"), lambda r: r.c_custkey, lambda r: r.o_custkey)
    big = lambda c: c.query("orders", alias="o").where(lambda r: r.o_totalprice > 400000)
    pair = lambda r: {"c": r.c.c_custkey, "o": r.o.o_orderkey}
    _add("j1_inner_join", lambda c: co(c).select(pair), "SELECT c_custkey AS c, o_orderkey AS o FROM customer JOIN orders ON c_custkey = o_custkey")
    _add("j2_left_join", lambda c: co(c, "left_join", big(c)).select(pair), "SELECT c_custkey AS c, o_orderkey AS o FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey")
    _add("j3_chained_join", lambda c: nr(c).join(c.query("customer", alias="c"), lambda r: r.n.n_nationkey, lambda r: r.c_nationkey).select(lambda r: {"c": r.c.c_custkey, "r": r.r.r_name}), "SELECT c_custkey AS c, r_name AS r FROM nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON n_nationkey = c_nationkey")
    _add("j4_chained_left_joins", lambda c: co(c, "left_join", big(c)).left_join(c.query("lineitem", alias="l").where(lambda r: r.l_quantity > 45), lambda r: r.o.o_orderkey, lambda r: r.l_orderkey).select(lambda r: {"c": r.c.c_custkey, "o": r.o.o_orderkey, "l": r.l.l_linenumber}), "SELECT c_custkey AS c, o_orderkey AS o, l_linenumber AS l FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 45) ON o_orderkey = l_orderkey")
    _add("j4_sibling_joins", lambda c: c.query("nation", alias="n").join(c.query("region", alias="r"), lambda r: r.n_regionkey, lambda r: r.r_regionkey).join(c.query("supplier", alias="s"), lambda r: r.n.n_nationkey, lambda r: r.s_nationkey).select(lambda r: {"s": r.s.s_suppkey, "r": r.r.r_name}), "SELECT s_suppkey AS s, r_name AS r FROM nation JOIN region ON n_regionkey = r_regionkey JOIN supplier ON n_nationkey = s_nationkey")
    _add("j5_self_join", lambda c: c.query("part", alias="a").join(c.query("part", alias="b"), lambda r: r.p_parent, lambda r: r.p_partkey).select(lambda r: {"child": r.a.p_partkey, "parent": r.b.p_name}), f"SELECT a.p_partkey AS child, b.p_name AS parent FROM {_P} a JOIN {_P} b ON a.p_parent = b.p_partkey")
    _add("j6_left_anti", lambda c: co(c, "left_join", big(c)).where(lambda r: r.o == None).select(lambda r: {"c": r.c.c_custkey}), "SELECT c_custkey AS c FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")  # noqa: E711
    picked = "(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders{})"
    firsts = lambda c, kids: kids.order_by_descending(lambda r: r.o_totalprice).then_by(lambda r: r.o_orderkey)
    _add("j7_first_row", lambda c: co(c, "first_row", firsts(c, c.query("orders", alias="o"))).select(pair), f"SELECT c_custkey AS c, o_orderkey AS o FROM customer JOIN {picked.format('')} ON c_custkey = o_custkey AND rn = 1")
    _add("j7_left_first_row", lambda c: co(c, "left_first_row", firsts(c, big(c))).select(pair), f"SELECT c_custkey AS c, o_orderkey AS o FROM customer LEFT JOIN {picked.format(' WHERE o_totalprice > 400000')} ON c_custkey = o_custkey AND rn = 1")
    _add("j7_first_row_then_where", lambda c: co(c, "first_row", firsts(c, c.query("orders", alias="o"))).where(lambda r: r.o.o_orderstatus == "F").select(pair), f"SELECT c_custkey AS c, o_orderkey AS o FROM customer JOIN {picked.format('')} ON c_custkey = o_custkey AND rn = 1 WHERE o_orderstatus = 'F'")
    _add("f4_filter_on_joined", lambda c: co(c).where(lambda r: (r.o.o_totalprice > 300000) & (r.c.c_acctbal > r.o.o_totalprice / 100)).select(pair), "SELECT c_custkey AS c, o_orderkey AS o FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 300000 AND c_acctbal > o_totalprice / 100")
    kids = lambda c: c.query("orders", alias="x")
    mine = lambda r, x: x.o_custkey == r.c_custkey
    quant = lambda n, f, s: _add(n, lambda c: c.query("customer", alias="c").where(lambda r: f(c, r)).select(lambda r: {"k": r.c_custkey}), f"SELECT c_custkey AS k FROM customer c WHERE {s}")
    has = lambda p: f"EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = c.c_custkey AND {p})"
    quant("j9_any", lambda c, r: kids(c).any(lambda x: mine(r, x) & (x.o_totalprice > 400000)), has("x.o_totalprice > 400000"))
    quant("j9_any_in_or", lambda c, r: kids(c).any(lambda x: mine(r, x) & (x.o_totalprice > 400000)) | (r.c_acctbal < 0), f"{has('x.o_totalprice > 400000')} OR c_acctbal < 0")
    quant("j10_not_any", lambda c, r: ~kids(c).any(lambda x: mine(r, x) & (x.o_totalprice > 400000)), f"NOT {has('x.o_totalprice > 400000')}")
    quant("j11_all", lambda c, r: kids(c).all(lambda x: mine(r, x) & (x.o_totalprice > 20000)), f"{has('TRUE')} AND NOT {has('x.o_totalprice <= 20000')}")
    quant("j11_all_and", lambda c, r: kids(c).all(lambda x: mine(r, x) & (x.o_totalprice > 20000) & (x.o_orderkey > 500)), f"{has('TRUE')} AND NOT {has('(x.o_totalprice <= 20000 OR x.o_orderkey <= 500)')}")
    quant("j12_not_all", lambda c, r: ~kids(c).all(lambda x: mine(r, x) & (x.o_totalprice > 20000)), has("x.o_totalprice <= 20000"))
    quant("j13_exists", lambda c, r: kids(c).exists(lambda x: mine(r, x) & (x.o_orderstatus == "P")), has("x.o_orderstatus = 'P'"))
    quant("j14_not_exists", lambda c, r: ~kids(c).exists(lambda x: mine(r, x) & (x.o_orderstatus == "P")), "NOT " + has("x.o_orderstatus = 'P'"))
    quant("j15_in", lambda c, r: kids(c).contains_key(lambda x: mine(r, x) & (x.o_totalprice > 300000)), has("x.o_totalprice > 300000"))
    quant("j16_not_in", lambda c, r: ~kids(c).contains_key(lambda x: mine(r, x) & (x.o_totalprice > 300000)), f"NOT {has('x.o_totalprice > 300000')}")
    quant("j17_outer_reference", lambda c, r: kids(c).any(lambda x: mine(r, x) & (x.o_totalprice > r.c_acctbal * 45)), has("x.o_totalprice > c.c_acctbal * 45"))
    _add("j18_filtered_outer", lambda c: c.query("customer", alias="c").where(lambda r: r.c_acctbal > 5000).join(c.query("orders", alias="o"), lambda r: r.c_custkey, lambda r: r.o_custkey).select(pair), "SELECT c_custkey AS c, o_orderkey AS o FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 5000")
    _add("j20_composition", lambda c: co(c).select(lambda r: {"c": r.c.c_custkey, "o": r.o.o_orderkey, "p": r.o.o_totalprice}).where(lambda r: r.p > 300000).select(lambda r: {"c": r.c, "o": r.o}), "SELECT c_custkey AS c, o_orderkey AS o FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 300000")
    # aggregates
    scalar = lambda n, func, f, s: _add(n, lambda c: c.query("orders").aggregate_df(func, f), f"SELECT {s} AS value FROM {_O}")
    scalar("a1_count", "count", lambda r: r.o_orderkey, "count(*)")
    scalar("a3_min", "min", lambda r: r.o_totalprice, "min(o_totalprice)")
    scalar("a4_max", "max", lambda r: r.o_totalprice, "max(o_totalprice)")
    scalar("a5_sum", "sum", lambda r: r.o_custkey, "sum(o_custkey)::BIGINT")
    _add("a6_average", lambda c: c.query("orders").aggregate_df("avg", lambda r: r.o_totalprice).select(F.round("value", 4).alias("value")), "SELECT round(avg(o_totalprice), 4) AS value FROM orders")
    scalar("a7_count_column", "count", lambda r: r.prio, "count(prio)")
    by = lambda n, key, shape, s, table="orders": _add(n, lambda c: c.query(table).group_by(key).select(shape), s)
    by("a9_group_null_key", lambda r: r.prio, lambda g: {"p": g.key, "n": g.count()}, f"SELECT prio AS p, count(*) AS n FROM {_O} GROUP BY 1")
    by("a10_group_constant", lambda r: 1, lambda g: {"n": g.count(), "m": g.max(lambda r: r.o_orderkey)}, "SELECT count(*) AS n, max(o_orderkey) AS m FROM orders")
    by("a11_composite_key", lambda r: {"s": r.o_orderstatus, "y": r.o_orderdate.year()}, lambda g: {"s": g.key.s, "y": g.key.y, "n": g.count()}, "SELECT o_orderstatus AS s, year(o_orderdate)::INTEGER AS y, count(*) AS n FROM orders GROUP BY 1, 2")
    for n, part, s in (("a12_year", "year", "year(o_orderdate)"), ("a12_month", "month", "month(o_orderdate)"), ("a12_day", "day", "day(o_orderdate)"), ("a13_week", "week", "week(o_orderdate)"), ("a13_quarter", "quarter", "quarter(o_orderdate)"), ("a14_fiscal_period", "fiscal_period", "quarter(o_orderdate)"), ("a14_fiscal_year", "fiscal_year", "year(o_orderdate)")):
        by(n, lambda r, part=part: getattr(r.o_orderdate, part)(), lambda g: {"k": g.key, "n": g.count()}, f"SELECT {s}::INTEGER AS k, count(*) AS n FROM orders GROUP BY 1")
    by("a17_aggregates", lambda r: r.o_orderstatus, lambda g: {"s": g.key, "lo": g.min(lambda r: r.o_totalprice), "hi": g.max(lambda r: r.o_totalprice), "keys": g.sum(lambda r: r.o_orderkey), "avg_key": g.average(lambda r: r.o_orderkey).apply(lambda c: F.round(c, 4))}, "SELECT o_orderstatus AS s, min(o_totalprice) AS lo, max(o_totalprice) AS hi, sum(o_orderkey)::BIGINT AS keys, round(avg(o_orderkey), 4) AS avg_key FROM orders GROUP BY 1")
    by("a18_count_column", lambda r: r.o_orderstatus, lambda g: {"s": g.key, "n": g.count_column(lambda r: r.prio)}, f"SELECT o_orderstatus AS s, count(prio) AS n FROM {_O} GROUP BY 1")
    by("a19_count_distinct", lambda r: r.o_orderstatus, lambda g: {"s": g.key, "n": g.count_distinct(lambda r: r.o_custkey)}, "SELECT o_orderstatus AS s, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1")
    _add("a20_join_group", lambda c: co(c).group_by(lambda r: r.c.c_mktsegment).select(lambda g: {"seg": g.key, "n": g.count(), "hi": g.max(lambda r: r.o.o_totalprice), "bal": g.min(lambda r: r.c.c_acctbal)}), "SELECT c_mktsegment AS seg, count(*) AS n, max(o_totalprice) AS hi, min(c_acctbal) AS bal FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
    _add("a21_linked_date_key", lambda c: co(c).group_by(lambda r: r.o.o_orderdate.month()).select(lambda g: {"m": g.key, "n": g.count()}), "SELECT month(o_orderdate)::INTEGER AS m, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
    by("a23_computed_aggregate", lambda r: r.o_orderstatus, lambda g: {"s": g.key, "spread": (g.max(lambda r: r.o_orderkey) - g.min(lambda r: r.o_orderkey)) + g.count() * 2, "kind": "status"}, "SELECT o_orderstatus AS s, max(o_orderkey) - min(o_orderkey) + count(*) * 2 AS spread, 'status' AS kind FROM orders GROUP BY 1")
    _add("a25_order_by_aggregate", lambda c: c.query("orders").group_by(lambda r: r.o_custkey).order_by(lambda g: g.count(), True).order_by(lambda g: g.key).select(lambda g: {"c": g.key, "n": g.count()}).take(10), "SELECT o_custkey AS c, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, c LIMIT 10")
    # distinct, order, limits, pages
    _add("o1_distinct", lambda c: c.query("orders").select(lambda r: {"s": r.o_orderstatus, "p": r.prio}).distinct(), f"SELECT DISTINCT o_orderstatus AS s, prio AS p FROM {_O}")
    _add("o2_order_take", lambda c: c.query("orders").order_by_descending(lambda r: r.o_totalprice).then_by(lambda r: r.o_orderkey).take(25).select(lambda r: {"k": r.o_orderkey}), "SELECT o_orderkey AS k FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
    _add("o4_order_by_linked", lambda c: co(c).order_by(lambda r: r.c.c_name).then_by(lambda r: r.o.o_orderkey).select(pair).take(40), "SELECT c_custkey AS c, o_orderkey AS o FROM customer JOIN orders ON c_custkey = o_custkey ORDER BY c_name, o_orderkey LIMIT 40")
    label = "printf('%02d', (p_size * 37) % 50)"
    _add("o5_order_by_label", lambda c: c.query("part").order_by(lambda r: r.p_size).then_by(lambda r: r.p_partkey).take(60).select(lambda r: {"k": r.p_partkey}), f"SELECT p_partkey AS k FROM part ORDER BY {label}, p_partkey LIMIT 60")
    _add("o5_raw_order", lambda c: c.query("part").with_raw_order().order_by(lambda r: r.p_size).then_by(lambda r: r.p_partkey).take(60).select(lambda r: {"k": r.p_partkey}), "SELECT p_partkey AS k FROM part ORDER BY p_size, p_partkey LIMIT 60")
    _add("o6_take_then_where", lambda c: c.query("orders").order_by(lambda r: r.o_orderkey).take(50).where(lambda r: r.o_orderstatus == "F").select(lambda r: {"k": r.o_orderkey}), "SELECT o_orderkey AS k FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 50) WHERE o_orderstatus = 'F'")
    _add("o12_page", lambda c: c.query("orders").order_by(lambda r: r.o_custkey).then_by(lambda r: r.o_orderkey).select(lambda r: {"c": r.o_custkey, "k": r.o_orderkey}).with_page_size(100).with_page(3), "SELECT o_custkey AS c, o_orderkey AS k FROM orders ORDER BY o_custkey, o_orderkey LIMIT 100 OFFSET 200")
    for h in ("HashJoin", "MergeJoin", "LoopJoin", "ForceOrder"):
        _add(f"q3_hint_{h.lower()}", lambda c, h=h: c.query("customer", alias="c").with_query_hints(h).join(c.query("orders", alias="o"), lambda r: r.c_custkey, lambda r: r.o_custkey).group_by(lambda r: r.c.c_mktsegment).select(lambda g: {"seg": g.key, "n": g.count()}), "SELECT c_mktsegment AS seg, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")


_define()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, (f, _) in _found.items()}


def oracle_sql() -> dict[str, str]:
    return {n: s for n, (_, s) in _found.items() if s is not None}
