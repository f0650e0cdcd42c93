"""Whole given tables against plain Python, row by row."""

import collections
import hashlib
import os
import re

import pytest

from siftwork.llm import decontaminate, jaccard_join, licenses, secrets

from .test_scans import words

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="the given tables are not here")
BASE = (
    ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
#: Texts that bring out what the table has few of; the long s and the Kelvin sign are no case of s and k.
PLANTED = [
    "PassWord = 'Zz09+/_.=-' token:short secret: 12345678 API_KEY=\"abcdefghi\" passwd=\u0130abcdefgh",
    "\U0001f600 AKIA0123456789ABCD AKIAAKIAAKIA AKIA\u00e9 " + "0f" * 16 + " " + "0f" * 15 + "F " + "g" + "a" * 33,
    "tokentoken=abcdefgh12 token =  \"secret=abcdefgh\" \u017fecret=abcdefgh12 to\u212aen=abcdefgh12",
    "MIT License; Apache-License, CC-BY. GNU General Public License cc by by cc mit mit license",
]


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    top = docs.agg({"doc_id": "max"}).first()[0]
    found = [tuple(r) for r in docs.collect()]
    return found + [(top + 1 + i, t) for i, t in enumerate(PLANTED)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_secret_base_columns(docs, rows):
    got = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        spans = []
        for order, (kind, pattern, group, least) in enumerate(BASE):
            spans += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
        base = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
        count = collections.Counter(kind for _, _, kind, _ in spans)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"]), (i, base, r.spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_license_base_columns(docs, rows):
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        w = words(text)
        hits = [(k, label) for label, p in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(hits), ",".join(sorted({x for _, x in hits})))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        assert {x for _, x in hits} <= set(r.labels.split(",")) | {""}


def test_overlap_columns(spark, docs, rows):
    """Every column of every pair: the seeds, the window around each hit, the best alignment."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    items = {r.item_id: words(r.text) for r in bench.collect()}
    seeds = collections.defaultdict(list)
    for item, w in items.items():
        for k, mask in enumerate(decontaminate.MASKS):
            for at in range(len(w) - mask[-1]):
                seeds[k, *(w[at + o] for o in mask)].append((item, at))
    first = items[min(items)]
    edited = [x if j % 9 else "other" for j, x in enumerate(first)]
    extra = [(10**6 + 1, " ".join(first)), (10**6 + 2, "so it is " + " ".join(edited)), (10**6 + 3, " ".join(first[:5])), (10**6 + 4, " ".join(first + first))]
    want = {}
    for doc, text in rows + extra:
        d, good = words(text), collections.defaultdict(list)
        for k, mask in enumerate(decontaminate.MASKS):
            for i in range(len(d) - mask[-1]):
                for item, at in seeds.get((k, *(d[i + o] for o in mask)), ()):
                    w = items[item]
                    same = [0 <= i - at + j < len(d) and d[i - at + j] == x for j, x in enumerate(w)]
                    size = min(len(w), 20)
                    begin = max(0, min(at - 6, len(w) - size))
                    if sum(same[begin : begin + size]) / size >= 0.8:
                        good[item].append((i, sum(same)))
        for item, hits in good.items():
            best = max(n for _, n in hits)
            want[doc, item] = (len(hits), best, best / len(items[item]), min(hits)[0], max(hits)[0])
    got = decontaminate.find_overlaps(docs.union(spark.createDataFrame(extra, docs.schema)), bench).collect()
    assert {(r.doc_id, r.item_id): (r.n_hits, r.n_matched, r.overlap, r.first_word, r.last_word) for r in got} == want
    assert {d for d, _ in want} >= {10**6 + 1, 10**6 + 4} and len(want) == len(got)


def test_links_against_all_pairs(docs, rows):
    """Classes and link counts of the whole table; recall is measured, and is whole here."""
    sets = {i: {tuple(w[k : k + min(5, len(w))]) for k in range(len(w) - min(5, len(w)) + 1)} if w else set() for i, w in ((i, words(t)) for i, t in rows)}
    text, links, root = dict(rows), collections.Counter(), {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(text)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both, least = len(sets[a] & sets[b]), min(len(sets[a]), len(sets[b]))
            if (text[a] or "") == (text[b] or "") or (least and both / (len(sets[a]) + len(sets[b]) - both) >= 0.8):
                links.update((a, b))
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: r for r in jaccard_join.jaccard_classes(docs).collect()}
    assert {i: r.class_id for i, r in got.items()} == {i: find(i) for i in ids}
    assert {i: r.n_links for i, r in got.items()} == {i: links[i] for i in ids}
