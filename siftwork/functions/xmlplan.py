"""A query's declarative plan as XML, for inspection; nothing is run."""

from __future__ import annotations

from typing import Any
from xml.etree import ElementTree as ET

from .expr import Aggregate, Attr, ChildCount, Choice, Computed, Cond, EntityRef, Junction, Part, Pred, Quantified

_NAMES = {"range": None, "length-eq": "like", "length-ne": "not-like", "set-eq": "eq", "set-ne": "ne"}


def _text(v: Any) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    return v.isoformat(" ") if hasattr(v, "isoformat") else str(v)


def _condition(parent: ET.Element, c: Cond, root: str) -> None:
    if c.op in ("empty", "not-empty"):
        f = ET.SubElement(parent, "filter", type="or" if c.op == "empty" else "and")
        _condition(f, Cond("null" if c.op == "empty" else "not-null", c.target), root)
        _condition(f, Cond("eq" if c.op == "empty" else "ne", c.target, ("",)), root)
        return
    t = c.target
    e = ET.SubElement(parent, "condition")
    if isinstance(t, EntityRef):
        e.set("entityname", t.alias)
        e.set("operator", c.op)
        return
    if isinstance(t, Attr):
        if t.alias != root:
            e.set("entityname", t.alias)
        e.set("attribute", t.name)
    else:
        e.set("attribute", "(computed)")
    args = list(c.args)
    if c.op in ("range", "not-range"):
        e.set("operator", ("not " if c.op[0] == "n" else "") + args.pop(0))
    elif c.op in ("like", "not-like"):
        e.set("operator", c.op)
        args = [args[0] + args[1] + args[2]]
    elif c.op.startswith("length-"):
        kind, n = c.op[7:], args[0]
        e.set("operator", "like" if kind in ("eq", "gt", "ge") else "not-like")
        args = ["_" * n + {"eq": "", "ne": "", "gt": "_%", "ge": "%", "lt": "%", "le": "_%"}[kind]]
    else:
        e.set("operator", _NAMES.get(c.op, c.op))
    if len(args) == 1 and isinstance(args[0], Attr):
        e.set("valueof", args[0].name if args[0].alias == root else f"{args[0].alias}.{args[0].name}")
    elif len(args) == 1 and c.op not in ("in", "not-in"):
        e.set("value", _text(args[0]))
    else:
        for a in args:
            ET.SubElement(e, "value").text = _text(a)


def _filter(parent: ET.Element, p: Pred, root: str) -> None:
    if isinstance(p, Junction):
        same = parent.tag == "filter" and parent.get("type") == p.kind
        f = parent if same else ET.SubElement(parent, "filter", type=p.kind)
        for x in p.parts:
            _filter(f, x, root)
    elif isinstance(p, Quantified):
        kind = {"all": "not all" if p.negative else "all"}.get(p.kind, "not any" if p.negative else p.kind)
        link = ET.SubElement(parent, "link-entity", {"name": p.source.name, "link-type": kind})
        _filter(ET.SubElement(link, "filter", type="and"), p.pred, p.source.alias)
    else:
        _condition(parent, p, root)


def _attribute(parent: ET.Element, where: dict, name: str, v: Any) -> None:
    def put(at: Attr, **more: str) -> None:
        attrs = {"name": at.name} | ({"alias": name} if name != at.name else {}) | more
        ET.SubElement(where.get(at.alias, parent), "attribute", attrs)

    if isinstance(v, Attr):
        put(v)
    elif isinstance(v, EntityRef):
        ET.SubElement(where.get(v.alias, parent), "all-attributes")
    elif isinstance(v, ChildCount):
        ET.SubElement(where.get(v.alias, parent), "attribute", {"alias": name, "rowaggregate": "CountChildren"})
    elif isinstance(v, Aggregate):
        more = {"aggregate": {"count-column": "countcolumn"}.get(v.func, v.func)} | ({"distinct": "true"} if v.distinct else {})
        if isinstance(v.of, Attr):
            put(v.of, **more)
        else:
            ET.SubElement(parent, "attribute", {"alias": name} | more)
    elif isinstance(v, Part) and isinstance(v.of, Attr):
        put(v.of, groupby="true", dategrouping=v.part)
    elif isinstance(v, dict):
        for k, x in v.items():
            _attribute(parent, where, k, x)
    elif isinstance(v, (Computed, Choice, Part)):
        for x in v.args if isinstance(v, Computed) else (v.then, v.other) if isinstance(v, Choice) else (v.of,):
            _attribute(parent, where, name if not isinstance(x, Attr) else x.name, x)


def to_xml(query, top: int | None = None, aggregate: tuple | None = None) -> str:
    """Slots in fixed order: attributes, orders, filters, links.

    ``top`` bounds the rows that a terminal asks for. ``aggregate`` is a scalar aggregate
    (its word and its selector, or None for the key or the one projected column): it takes
    the place of the attributes, and orders don't matter to it.
    """
    from ..operators.lowering import Scope
    from ..operators.query import Group

    fetch = ET.Element("fetch")
    for k in query.options:
        fetch.set(k, "true")
    if query.retained:
        fetch.set("datasource", "retained")
    if query.hints:
        fetch.set("options", ",".join(query.hints))
    if query.page_size is not None:
        fetch.set("count", str(query.page_size))
    if query.page_number is not None:
        fetch.set("page", str(query.page_number))
    if query.aggregate_limit is not None:
        fetch.set("aggregatelimit", str(query.aggregate_limit))
    if query.raw_order:
        fetch.set("useraworderby", "true")
    if query.on_count is not None:
        fetch.set("returntotalrecordcount", "true")
    entity = ET.SubElement(fetch, "entity", name=query.name)
    scope = Scope(query.catalog, query.alias)
    query._names(scope)
    ref = scope.ref
    where, attributes, orders, filters, links = {query.alias: entity}, [], [], [], []
    key = None
    for step in query.steps:
        kind = step[0]
        if kind == "where":
            filters.append(step[1](ref()))
        elif kind == "join":
            _, how, inner, outer_key, inner_key, alias = step
            mine = Scope(inner.catalog, inner.alias)
            inner._names(mine)
            a, b = inner_key(mine.ref()), outer_key(ref())
            link = ET.Element("link-entity", {"name": inner.name, "from": a.name, "to": b.name, "alias": alias, "link-type": {"inner": "inner", "left": "outer", "first": "matchfirstrowusingcrossapply", "left-first": "matchfirstrowusingouterapply"}[how]})
            for s in inner.steps:
                if s[0] == "where":
                    _filter(_root_filter(link), s[1](mine.ref()), inner.alias)
                elif s[0] == "order":
                    v = s[1](mine.ref())
                    orders.append((alias, v, s[2]))
            where[alias] = link
            links.append((b.alias, link))
        elif kind == "order":
            f = step[1]
            orders.append((None, f(Group(key, ref())) if key is not None else f(ref()), step[2]))
        elif kind == "group":
            key = step[1](ref())
            fetch.set("aggregate", "true")
        elif kind == "select":
            shape = step[1](Group(_plain_key(key), ref())) if key is not None else step[1](ref())
            shape = shape if isinstance(shape, dict) else {shape.name if isinstance(shape, Attr) else "value": shape}
            attributes = [(k, v) for k, v in shape.items()]
            scope.projected, key = list(shape), None
        elif kind == "take":
            fetch.set("top", str(step[1]))
        elif kind == "distinct":
            fetch.set("distinct", "true")
    if top is not None:
        fetch.set("top", str(min(top, int(fetch.get("top", top)))))
    if aggregate is not None:
        word, selector = aggregate
        one = selector(ref()) if selector else attributes[0][1] if len(attributes) == 1 and word != "count" else None
        fetch.set("aggregate", "true")
        name = one.name if isinstance(one, Attr) else query.catalog.entity(query.name).primary_id or query.name
        ET.SubElement(where.get(one.alias, entity) if isinstance(one, Attr) else entity, "attribute", {"name": name, "alias": "value", "aggregate": word})
        orders = []
    elif attributes:
        for k, v in attributes:
            _attribute(entity, where, k, v)
    elif query.columns:
        for c in query.columns:
            ET.SubElement(entity, "attribute", name=c)
    else:
        ET.SubElement(entity, "all-attributes")
    for alias, v, descending in orders:
        if isinstance(v, Attr):
            at = {"attribute": v.name}
            if alias or v.alias != query.alias:
                at = {"entityname": alias or v.alias} | at
            ET.SubElement(entity, "order", at | ({"descending": "true"} if descending else {}))
    if filters:
        root = ET.SubElement(entity, "filter", type="and")
        for p in filters:
            _filter(root, p, query.alias)
    for owner, link in links:
        where.get(owner, entity).append(link)
    ET.indent(fetch)
    return ET.tostring(fetch, encoding="unicode")


def _root_filter(link: ET.Element) -> ET.Element:
    found = link.find("filter")
    return ET.SubElement(link, "filter", type="and") if found is None else found


def _plain_key(key: Any) -> Any:
    class Keys(dict):
        __getattr__ = dict.__getitem__

    return Keys(key) if isinstance(key, dict) else key
