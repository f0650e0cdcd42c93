"""Null rules, element operators, paging, hooks and the meaning of step order."""

import asyncio
import datetime as dt
import enum

import pytest

from siftwork.functions import dates
from siftwork.functions.expr import UnsupportedPredicate, choose, text
from siftwork.operators import decode
from siftwork.operators.lowering import UnsupportedQuery
from siftwork.operators.query import EmptySequence, MoreThanOne
from siftwork.sources.catalog import Catalog, Context, Entity

RATINGS = (100000000, 100000001, 100000002)
COLORS = ([0], [8, 5, 0], [2], [6, 7, 1], [2, 8], [3, 4])


class Rating(enum.IntEnum):
    COLD, WARM, HOT = RATINGS


@pytest.fixture(scope="module")
def c(spark):
    accounts = []
    for i in range(1, 101):
        parent = None if i <= 10 or i > 50 else f"a{(i - 11) // 4 + 1:03}"
        accounts.append((f"a{i:03}", f"Account {i:03}", None if i % 5 == 0 else RATINGS[i % 3], None if i % 7 == 0 else float(i * 1000), None if i % 4 == 0 else dt.datetime(2000 + i % 25, i % 12 + 1, i % 28 + 1), None if i % 6 == 0 else f"Description {i}", parent, f"c{(i - 1) * 5 + 1:03}", "u1" if i % 2 else "u2"))
    accounts += [(f"e{i:03}", f"Empty {i:03}", None, None, None, None, None, None, "u1") for i in range(1, 51)]
    contacts = []
    for a in range(1, 101):
        for n in range(1, 6):
            k = (a - 1) * 5 + n
            contacts.append((f"c{k:03}", f"First{a:03}", f"Last{n}", f"a{a:03}", None if k % 4 == 0 else RATINGS[k % 3], None if k % 6 == 0 else COLORS[(k - 1) % 6], None if k % 7 == 0 else "x" * (k % 100 + 1)))
    adf = spark.createDataFrame(accounts, "id string, name string, rating int, credit double, organised timestamp_ntz, description string, parent string, primary string, owner string").cache()
    cdf = spark.createDataFrame(contacts, "id string, first string, last string, account string, rating int, colors array<int>, filler string").cache()
    return Catalog(spark, [Entity("account", lambda s: adf, "id", "parent", {"rating": {RATINGS[0]: "Cold", RATINGS[1]: "Warm", RATINGS[2]: "Hot"}}), Entity("contact", lambda s: cdf, "id")], Context(dates.Clock(dt.datetime(2010, 5, 5, 12)), "u1"))


def joined(c, how="join"):
    return getattr(c.query("account", alias="a"), how)(c.query("contact", alias="k"), lambda r: r.id, lambda r: r.account)


def n(q):
    return q.to_df().count()


def test_cardinalities(c):
    assert c.query("account").count() == 150
    assert n(c.query("account").where(lambda r: r.primary != None)) == 100  # noqa: E711
    assert n(joined(c)) == 500 and n(joined(c, "left_join")) == 550
    assert n(joined(c, "left_join").where(lambda r: r.k == None)) == 50  # noqa: E711
    assert n(joined(c, "first_row")) == 100 and n(joined(c, "left_first_row")) == 150
    g = c.query("account").group_by(lambda r: r.rating).select(lambda g: {"r": g.key, "n": g.count()}).to_list()
    assert sum(r.n for r in g) == 150 and any(r.r is None for r in g)


PREDICATES = {
    "eq": lambda r: r.v == "bb", "like": lambda r: r.v.contains("b"), "starts": lambda r: r.v.startswith("b"), "in": lambda r: r.v.is_in(["bb"]),
    "len_eq": lambda r: r.v.length() == 2, "len_lt": lambda r: r.v.length() < 3, "len_gt": lambda r: r.v.length() > 1,
    "tags": lambda r: r.t.contains_values(1, 9), "set": lambda r: r.t.set_equals(1, 2), "empty": lambda r: r.v.is_null_or_empty(),
}
#: Kept ids (1 matches, 2 differs, 3 is null) of the condition and of its negation.
TRUTH = {
    "eq": ([1], [2, 3]), "like": ([1], [2, 3]), "starts": ([1], [2, 3]), "in": ([1], [2, 3]), "len_eq": ([1], [2, 3]), "len_lt": ([1, 3], [2]), "len_gt": ([1, 2], [3]),
    "tags": ([1], [2, 3]), "set": ([1], [2, 3]), "empty": ([3], [1, 2]),
}


@pytest.mark.parametrize("name", sorted(PREDICATES))
def test_null_rules(spark, name):
    df = spark.createDataFrame([(1, "bb", [2, 1]), (2, "cccc", [5]), (3, None, None)], "id int, v string, t array<int>")
    q = Catalog(spark, [Entity("t", lambda s: df, "id")]).query("t")
    ids = lambda f: sorted(r.id for r in q.where(f).to_list())
    f = PREDICATES[name]
    assert (ids(f), ids(lambda r: ~f(r))) == TRUTH[name]
    assert ids(lambda r: ~~f(r)) == TRUTH[name][0]


def test_complements(c):
    every = 150
    assert n(c.query("account").where(lambda r: r.id.under("a001"))) == 4
    assert n(c.query("account").where(lambda r: r.id.under("a001"))) + n(c.query("account").where(lambda r: r.id.not_under("a001"))) == every
    assert {r.id for r in c.query("account").where(lambda r: r.id.above_or_equal("a011")).to_list()} == {"a001", "a011"}
    assert n(c.query("account").where(lambda r: r.owner.equal_user_id())) + n(c.query("account").where(lambda r: r.owner.not_equal_user_id())) == every
    kids = lambda r, p: c.query("contact", alias="k").all(lambda k: (k.account == r.id) & p(k))
    good = lambda k: (k.rating == Rating.HOT) | (k.last == "Last1")
    yes, no = n(c.query("account").where(lambda r: kids(r, good))), n(c.query("account").where(lambda r: ~kids(r, good)))
    assert yes + no == 100  # parents without children are in neither
    a = {r.id for r in c.query("account").where(lambda r: c.query("contact", alias="k").exists(lambda k: (k.account == r.id) & (k.rating == Rating.WARM))).to_list()}
    b = {r.id for r in c.query("account").where(lambda r: c.query("contact", alias="k").contains_key(lambda k: (k.account == r.id) & (k.rating == Rating.WARM))).to_list()}
    assert a == b and a


def test_successive_wheres_are_anded(c):
    q = c.query("account").where(lambda r: (r.id == "a001") | (r.id == "a002")).where(lambda r: r.name == "Account 001")
    assert [r.id for r in q.to_list()] == ["a001"]


def test_captured_none_and_constants_on_the_left(c):
    missing = None
    assert n(c.query("account").where(lambda r: r.rating == missing)) == 70
    assert n(c.query("account").where(lambda r: 2000.0 > r.credit)) == 1


def test_inner_filter_of_a_join_holds(c):
    q = c.query("account", alias="a").join(c.query("contact", alias="k").where(lambda k: k.last == "Last2"), lambda r: r.id, lambda k: k.account)
    assert n(q) == 100
    first = c.query("account", alias="a").first_row(c.query("contact", alias="k").where(lambda k: k.last != "Last5").order_by_descending(lambda k: k.last), lambda r: r.id, lambda k: k.account)
    assert {r.v for r in first.select(lambda r: {"v": r.k.last}).to_list()} == {"Last4"}


def test_refusals(c):
    with pytest.raises(ValueError):
        c.query("account").where(lambda r: r.id.is_in([])).to_df()
    with pytest.raises(UnsupportedPredicate):
        c.query("account").where(lambda r: c.query("contact").any(lambda k: k.last == "x")).to_df()
    with pytest.raises(UnsupportedPredicate):
        c.query("account").where(lambda r: ~r.id.above("a011")).to_df()
    with pytest.raises(UnsupportedQuery):
        c.query("account").select(lambda r: {"x": r.nothing}).to_df()
    with pytest.raises(UnsupportedQuery):
        c.query("account").group_by(lambda r: r.rating).take(3).to_df()
    with pytest.raises(UnsupportedPredicate):
        c.query("account").attr if False else c.query("account").where(lambda r: r.attr(None) == 1).to_df()


def test_elements(c):
    q = c.query("account").order_by(lambda r: r.id)
    assert q.first().id == "a001" and q.first(lambda r: r.id > "a005").id == "a006"
    assert q.first_or_default(lambda r: r.id == "zz") is None and q.single_or_default(lambda r: r.id == "zz") is None
    assert q.single(lambda r: r.id == "a007").name == "Account 007"
    with pytest.raises(EmptySequence):
        q.first(lambda r: r.id == "zz")
    with pytest.raises(EmptySequence):
        q.single(lambda r: r.id == "zz")
    with pytest.raises(MoreThanOne):
        q.single()
    with pytest.raises(EmptySequence):
        q.where(lambda r: r.id == "zz").sum(lambda r: r.credit)
    assert q.max(lambda r: r.credit) == 100000.0 and q.count_column(lambda r: r.credit) == 86
    assert q.select(lambda r: r.credit).min() == 1000.0


def test_pages_and_counts(c):
    q = c.query("account").order_by(lambda r: r.name).select(lambda r: {"id": r.id})
    every, pages, seen = [r.id for r in q.to_list()], [], []
    q.with_page_size(40).for_each_page(lambda p: pages.append([r.id for r in p]))
    assert [len(p) for p in pages] == [40, 40, 40, 30] and sum(pages, []) == every
    assert [r.id for r in q.with_page_size(40).with_page(2).to_list()] == every[40:80]
    q.with_page_size(10).with_page(1).return_record_count(seen.append).to_list()
    assert seen[0].total == 150 and not seen[0].limit_exceeded
    stopped = []
    q.with_page_size(40).for_each_page(lambda p: bool(stopped.append(len(p))))
    assert stopped == [40]
    for bad in (lambda: q.with_page(0), lambda: q.with_aggregate_limit(0), lambda: q.with_aggregate_limit(50001)):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(OverflowError):
        c.query("account").with_aggregate_limit(10).count()


def test_labels_sort_by_default(c):
    q = c.query("account").where(lambda r: r.rating != None).select(lambda r: {"r": r.rating})  # noqa: E711
    base = c.query("account").where(lambda r: r.rating != None)  # noqa: E711
    assert base.order_by(lambda r: r.rating).first().rating == Rating.COLD and base.order_by_descending(lambda r: r.rating).first().rating == Rating.WARM
    assert base.with_raw_order().order_by_descending(lambda r: r.rating).first().rating == Rating.HOT
    assert n(q.distinct()) == 3


def test_projection(c):
    q = joined(c, "left_join").order_by(lambda r: r.a.id).select(lambda r: {"a": r.a, "k": r.k, "t": text(r.a.name, "!"), "kind": choose(r.k == None, "none", "some")})  # noqa: E711
    got = q.to_list()
    assert got[0].a.name == "Account 001" and got[0].kind == "some" and got[-1].k is None and got[-1].kind == "none"
    kids = c.query("account").select(lambda r: {"id": r.id, "n": r.count_children()}).to_list()
    assert {r.id: r.n for r in kids}["a001"] == 4 and {r.id: r.n for r in kids}["a050"] == 0


def test_hooks_in_order(c):
    log = []
    decode.before_materialise.append(lambda r: log.append("gb"))
    decode.after_materialise.append(lambda r, x: log.append("ga"))
    try:
        q = c.query("account").take(1).on_before_materialise(lambda r: log.append("qb")).on_after_materialise(lambda r, x: (log.append("qa"), 7)[1])
        assert q.to_list() == [7] and log == ["gb", "qb", "ga", "qa"]
        log.clear()
        q.count()
        assert log == []
    finally:
        decode.before_materialise.clear()
        decode.after_materialise.clear()


def test_async_and_cancellation(c):
    q = c.query("account").order_by(lambda r: r.id)
    assert asyncio.run(q.first_async()).id == "a001"
    assert asyncio.run(q.count_async(lambda r: r.rating == Rating.HOT)) == n(q.where(lambda r: r.rating == Rating.HOT))
    token = decode.CancelToken()
    token.cancel()
    with pytest.raises(decode.Cancelled):
        asyncio.run(q.to_list_async(token=token))


def test_plan_text(c):
    plans = []
    q = joined(c).where(lambda r: ~((r.a.credit < 5) | r.k.last.contains("9"))).order_by(lambda r: r.k.last).select(lambda r: {"id": r.a.id, "last": r.k.last}).with_query_hints("HashJoin").take(5).capture_plan(plans.append)
    xml = q.to_xml()
    assert 'options="HashJoin"' in xml and 'top="5"' in xml and '<condition attribute="credit" operator="ge" value="5" />' in xml
    assert '<condition entityname="k" attribute="last" operator="not-like" value="%9%" />' in xml and 'link-type="inner"' in xml
    q.to_list()
    assert plans == [xml]


def test_date_bounds():
    c = dates.Clock(dt.datetime(2024, 3, 31, 15, 45), fiscal_month=7)
    b = dates.RANGES["last-x-months"](c, 1)
    assert b.low == dt.datetime(2024, 2, 29) and b.high == c.now
    assert dates.RANGES["this-fiscal-year"](c).low == dt.datetime(2023, 7, 1)
    assert dates.RANGES["this-week"](c).low == dt.datetime(2024, 3, 31)
    assert dates.RANGES["in-fiscal-period-and-year"](c, 2, 2023).low == dt.datetime(2023, 10, 1)
    assert len(dates.RANGES) == 43  # between and not-between stand apart


def test_hierarchies_of_any_depth_and_cycles(spark):
    from siftwork.operators import hierarchy

    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(71)] + [(100, 101), (101, 100)], "id long, parent long")
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(hierarchy.below(chain, "id", "parent", 0, True)) == list(range(71))
    assert ids(hierarchy.below(chain, "id", "parent", 100, True)) == [100, 101]


def chain(spark, rows):
    """A catalog of one self-referencing entity of (id, parent) rows."""
    import tempfile

    where = tempfile.mkdtemp() + "/node.parquet"
    spark.createDataFrame(rows, "id long, parent long").coalesce(2).write.parquet(where)
    return Catalog(spark, [Entity("node", where, "id", parent="parent")])


def test_hierarchies_of_any_depth_and_cycles(spark):
    c = chain(spark, [(i, i - 1 if i > 1 else None) for i in range(1, 101)] + [(2001, 2003), (2002, 2001), (2003, 2002), (3001, 50)])
    ids = lambda f: sorted(r.id for r in c.query("node").where(f).to_df().collect())
    assert ids(lambda r: r.id.under(1)) == [*range(2, 101), 3001]
    assert ids(lambda r: r.id.above(100)) == list(range(1, 100))
    assert ids(lambda r: r.id.under_or_equal(2001)) == [2001, 2002, 2003]
    assert ids(lambda r: r.id.not_under(2)) == [1, 2, 2001, 2002, 2003]
    plan = c.query("node").where(lambda r: r.id.not_under(2)).to_df()._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "LeftAnti" in plan


def test_backslashes_are_plain_characters(spark, tmp_path):
    rows = [(1, "a\\bc"), (2, "a%"), (3, "zz"), (4, "x\\"), (5, None), (6, "a\\b%c")]
    spark.createDataFrame(rows, "id long, v string").write.parquet(f"{tmp_path}/t.parquet")
    c = Catalog(spark, [Entity("t", f"{tmp_path}/t.parquet", "id")])
    ids = lambda f: sorted(r.id for r in c.query("t").where(f).to_df().collect())
    assert ids(lambda r: r.v.startswith("a\\")) == [1, 6] and ids(lambda r: r.v.contains("\\")) == [1, 4, 6] and ids(lambda r: r.v.endswith("\\")) == [4]
    assert ids(lambda r: ~r.v.contains("\\")) == [2, 3, 5] and ids(lambda r: r.v.startswith("a\\%c")) == [1, 6]


def test_plans_of_terminals_that_do_not_run(c):
    q = c.query("account").where(lambda r: r.id == "a001").order_by(lambda r: r.id)
    seen = []
    count = q.to_xml(lambda q: q.count())
    assert 'aggregate="count"' in count and "<order" not in count and "a001" in count
    assert 'aggregate="max"' in q.to_xml(lambda q: q.max(lambda r: r.id)) and 'top="1"' in q.to_xml(lambda q: q.first()) and 'top="2"' in q.to_xml(lambda q: q.single())
    assert "all-attributes" in q.to_xml(lambda q: q.to_list()) and "all-attributes" in q.to_xml(lambda q: q.for_each_page(print))
    q.capture_plan(seen.append).count()
    assert seen == [count]
    with pytest.raises(ValueError):
        q.to_xml(lambda q: None)


def test_comparers_are_refused(c):
    with pytest.raises(UnsupportedPredicate):
        c.query("account").where(lambda r: r.id.is_in(["a"], comparer=str.lower)).to_df()


def test_joins_after_a_projection(spark, tmp_path):
    spark.createDataFrame([(1, "x", 10), (2, "y", 20), (3, "z", None)], "id long, n string, fk long").write.parquet(f"{tmp_path}/t.parquet")
    spark.createDataFrame([(10, "p", 1), (20, "q", 2)], "id long, v string, w long").write.parquet(f"{tmp_path}/u.parquet")
    c = Catalog(spark, [Entity("t", f"{tmp_path}/t.parquet", "id"), Entity("u", f"{tmp_path}/u.parquet", "id")])
    q = c.query("t").select(lambda r: {"k": r.fk, "n": r.n}).join(c.query("u").order_by(lambda r: r.w, True).then_by(lambda r: r.v), lambda r: r.k, lambda r: r.id)
    assert [(r.k, r.n, r.u.v) for r in q.to_df().collect()] == [(20, "y", "q"), (10, "x", "p")]
    assert [r.n for r in q.where(lambda r: r.u.v == "p").to_df().collect()] == ["x"]
    assert [tuple(r) for r in q.where(lambda r: r.u.w > 1).select(lambda r: {"a": r.n, "b": r.u.v}).to_df().collect()] == [("y", "q")]
    grouped = q.group_by(lambda r: r.u.v).select(lambda g: {"v": g.key, "n": g.count()}).to_df().collect()
    assert sorted(tuple(r) for r in grouped) == [("p", 1), ("q", 1)]
