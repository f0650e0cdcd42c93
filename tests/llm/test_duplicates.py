import collections
import itertools
import random
import re
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from siftwork.llm import jaccard_join, linededup, neardup, quality, substrings, units
from siftwork.llm.textkernel import Words, shingles

from .conftest import frame


def grams(t):
    w = Words([t or ""])
    return set(shingles(w.hash, min(5, len(w.hash))).tolist()) if len(w.hash) else set()


def classes(rows):
    """class and links of each row by comparing all of them."""
    s = [grams(t) for _, t in rows]
    near = lambda a, b: s[a] and s[b] and len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b]) or (rows[a][1] or "") == (rows[b][1] or "")
    group, links = list(range(len(rows))), [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if near(a, b):
            links[a] += 1
            links[b] += 1
            x, y = group[a], group[b]
            group = [x if g == y else g for g in group]
    least = {}
    for i, g in enumerate(group):
        least[g] = min(least.get(g, 10**9), -1 if rows[i][0] is None else rows[i][0])
    return [(rows[i][0], None if least[g] == -1 else least[g], links[i]) for i, g in enumerate(group)]


def corpus(prose):
    rows, doc = [], 0
    for g in range(12):
        base = prose(120).split()
        for k in range(g % 5 + 1):
            w = list(base)
            for j in range(k):
                w[(7 * j * (g + 1)) % 120] = f"edit{g}{k}{j}"
            rows.append((doc, " ".join(w)))
            doc += 1
    return rows + [(doc, rows[0][1]), (doc + 1, "one two"), (doc + 2, "one two"), (doc + 3, None), (doc + 4, ""), (None, "lone text here"), (doc + 5, prose(4000))]


def key(r):
    return tuple(-5 if x is None else x for x in r)


def test_join_against_all_pairs(spark, prose):
    rows = corpus(prose)
    got = [tuple(r) for r in jaccard_join.jaccard_classes(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(classes(rows), key=key)


def test_large_buckets_are_split_and_parted(spark, prose, monkeypatch):
    """The same result where every bucket counts as large and every part is tiny."""
    monkeypatch.setattr(neardup, "PART_ROWS", 2)
    rows = corpus(prose)
    got = [tuple(r) for r in jaccard_join.jaccard_classes(frame(spark, rows), small=2, depth=1, recall=0.9999).collect()]
    assert sorted(got, key=key) == sorted(classes(rows), key=key)


def test_keep_one_of_each_class(spark, prose):
    rows = corpus(prose)
    rows.append(rows[0])
    df = frame(spark, rows)
    got = jaccard_join.keep_one(df)
    assert got.columns == df.columns
    want = {c for _, c, _ in classes(rows)}
    assert sorted(r.doc_id for r in got.where("doc_id is not null").collect()) == sorted(c for c in want if c is not None)


def test_duplicates_of_awkward_rows(awkward, nothing):
    df, rows = awkward
    assert jaccard_join.jaccard_classes(df).count() == len(rows) and jaccard_join.jaccard_classes(nothing).count() == 0
    assert jaccard_join.keep_one(nothing).count() == 0
    out = linededup.dedup_lines(df, removed_col="gone")
    assert out.count() == len(rows) and out.columns == [*df.columns, "gone"] and linededup.dedup_lines(nothing).count() == 0
    texts = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert texts[3] is None and texts[4] == "" and texts[5] == " \n\n \t" and texts[2] == ""
    assert substrings.repeated_passages(nothing).count() == 0
    assert {r.doc_id for r in substrings.repeated_passages(df).collect()} == {1, 2, 7}


def test_lines_against_brute_force(spark, prose):
    lines = [prose(14) for _ in range(8)]
    near = lines[0].replace(lines[0].split()[5], "zz", 1)
    rows = [(2, "\n".join([lines[0], lines[1], "", lines[1]])), (1, "\n".join([near, lines[2]])), (3, "\n".join([lines[2].upper(), lines[3], "--", "--"])), (4, "ab\nab\nabc"), (5, lines[4] + "\r\n" + lines[5])]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(frame(spark, rows)).collect()}

    def s(line):
        b = line.lower()
        return {b[i : i + 8] for i in range(max(1, len(b) - 7))}

    order = [(d, n, x) for d, t in sorted(rows) for n, x in enumerate(t.split("\n")) if len(Words([x]).hash)]
    group = list(range(len(order)))
    for a, b in itertools.combinations(range(len(order)), 2):
        x, y = s(order[a][2]), s(order[b][2])
        if len(x & y) >= 0.8 * len(x | y):
            ga, gb = group[a], group[b]
            group = [ga if g == gb else g for g in group]
    gone = collections.defaultdict(set)
    for i, g in enumerate(group):
        if group.index(g) != i:
            gone[order[i][0]].add(order[i][1])
    assert any(gone.values())
    for d, t in rows:
        assert got[d] == "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d])


def test_passages_are_found_inside_other_text(spark, prose):
    passage = prose(63)
    rows = [(i, prose(40) + " " + passage + " " + prose(30) if i % 3 == 0 else prose(120)) for i in range(30)]
    got = substrings.repeated_passages(frame(spark, rows)).collect()
    assert {r.doc_id for r in got} == {i for i in range(30) if i % 3 == 0}
    text = dict(rows)
    for r in got:
        assert text[r.doc_id][r.start : r.end].strip(".") in passage or r.n_words > 50
        assert (r.n_removed == 0) == (r.doc_id == 0)


def test_classifier_learns_and_holds_out(spark, prose):
    import zlib

    rows = [(i, prose(60) if i % 4 else " ".join(f"{w.upper()}!!" for w in prose(60).split())) for i in range(600)] + [(1000, None), (1001, "")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(600)] + [(None, 1, 0), (5, None, 0), (3000, 1, 1)], "doc_id long, quality int, toxic int")
    df = frame(spark, rows)
    model = quality.train(df, labels, trees=20)
    got = {r.doc_id: r for r in quality.score_documents(df, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i in range(600) if got[i].held_out]
    assert sum(got[i].predicted == int(i % 4 > 0) for i in held) >= 0.98 * len(held)
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got.values())
    none = quality.train(df, labels.limit(0))
    assert {r.score for r in quality.score_documents(df.limit(3), none).collect()} == {0.5}
    assert quality.score_documents(frame(spark, []), model).count() == 0


def test_passages_of_51_words_wherever_they_begin(spark, prose):
    """Mid-sentence, unpunctuated, of few words; two texts under one id and null ids are told apart."""
    passages = [prose(51), prose(51).replace(".", ""), " ".join(prose(6).split()[i * i % 6] for i in range(60))]
    rows = []
    for k, p in enumerate(passages):
        for j in range(8):
            rows.append((100 * k + j, prose(13 + 7 * j) + " " + p + " " + prose(30)))
    rows += [(900, prose(80)), (901, prose(80)), (902, prose(80).upper())]
    shared = prose(60)
    rows += [(950, prose(20) + " " + shared), (950, shared + " " + prose(20)), (None, prose(33) + " " + shared), (None, prose(70))]
    got = substrings.repeated_passages(frame(spark, rows)).collect()
    assert {r.doc_id for r in got} == {100 * k + j for k in range(3) for j in range(8)} | {950, None}
    assert all(20 <= r.n_words <= 62 for r in got) and sum(r.doc_id == 950 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1


def test_lines_of_null_ids_and_other_scripts(spark, prose):
    line = "\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059\u3002" * 3
    rows = [(None, f"{line}\nfirst one"), (None, f"other\n{line}"), (1, f"{line}!\nkept"), (1, f"{line}\nkept as well")]
    got = sorted(r.text for r in linededup.dedup_lines(frame(spark, rows)).collect())
    assert sum(line in t for t in got) == 1 and len(got) == 4 and {"kept", "kept as well"} <= set(got)
    many = spark.range(300).selectExpr("cast(null as long) as doc_id", "concat('unlike ', sha2(cast(id as string), 256), '\n', 'the same line in all of them') as text")
    out = [r.text for r in linededup.dedup_lines(many).collect()]
    assert len(out) == 300 and sum("the same line" in t for t in out) == 1


def test_classes_do_not_depend_on_splitting(spark):
    """op5: pairs of units at the threshold, all in one bucket, that is split or compared whole."""
    rnd, rows = random.Random(5), []
    for i in range(1500):
        line = [rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(81)]
        rows.append((2 * i, "".join(line)))
        line[40] = "#"  # shares 66 of 82 shingles
        rows.append((2 * i + 1, "".join(line)))
    docs = units.keyed_texts(frame(spark, rows), "doc_id", "text")
    lines = units.unit_rows(docs, units.Lines(), 1, 1).withColumn("keys", F.array(F.lit(7).cast("long")))
    found = [sorted(map(tuple, units.unit_classes(docs, lines, units.Lines(), threshold=0.8, small=small).collect())) for small in (40, 10**9)]
    assert found[0] == found[1] and len(found[1]) == 3000


def test_prefix_keys_lose_no_pair():
    rnd = random.Random(6)
    for threshold in (0.5, 0.8, 0.9):
        common = [rnd.getrandbits(64) for _ in range(30)]
        sets = [[7]]
        for _ in range(200):
            own = rnd.sample(common, rnd.randint(1, 30)) + [rnd.getrandbits(64) for _ in range(rnd.randint(0, 4))]
            sets += [own, own[: rnd.randint(1, len(own))] + own[:2], own + rnd.sample(common, 4)]
        key = np.full(len(sets), 3, np.uint64)
        for levels in (np.zeros(neardup.SLOTS, np.uint8), np.arange(neardup.SLOTS).astype(np.uint8)):
            values, count = np.array(sum(sets, []), np.uint64), np.array([len(x) for x in sets])
            members, keys = neardup.prefix_keys(values, count, key, np.tile(levels, (len(sets), 1)), threshold)
            of = collections.defaultdict(set)
            for m, k in zip(members.tolist(), keys.tolist(), strict=True):
                of[m].add(k)
            pairs = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if len({*sets[i]} & {*sets[j]}) >= threshold * len({*sets[i]} | {*sets[j]})]
            assert len(pairs) > 100 and all(of[i] & of[j] for i, j in pairs)


def test_stable_order():
    """Also of keys that agree in all bits that are sorted but the places."""
    rnd = np.random.default_rng(7)
    for n in (0, 1, 2, 3, 1000, 70_000):
        for top in (2, 50, 2**63):
            key = rnd.integers(0, top, n).astype(np.uint64) * np.uint64(2)
            assert (neardup.stable_order(key) == np.argsort(key, kind="stable")).all()


def test_split_takes_members_of_a_template_apart(spark):
    """op5: members that share much, but not enough, meet no more; the only near pair does."""
    rnd = random.Random(8)
    common = [rnd.getrandbits(63) for _ in range(12)]
    sets = [common + [rnd.getrandbits(63) for _ in range(8)] for _ in range(300)]
    sets.append(sets[0][:-1] + [rnd.getrandbits(63)])
    held = spark.createDataFrame([(i, bytearray(np.sort(np.array(x, np.uint64)).tobytes())) for i, x in enumerate(sets)], "uid long, set binary")
    buckets = spark.createDataFrame([(5, i) for i in range(len(sets))], "key long, uid long")
    assert {r.uid for r in neardup.split_exactly(buckets, held, 50, 0.8, 2).collect()} == {0, 300}


def test_word_and_line_places_without_arrays_a_byte(spark):
    """Places in bytes and code points against plain Python; kernels hold fewer arrays as long as the text."""
    rnd, kind = random.Random(4), units.Lines()
    texts = ["".join(rnd.choice(["a", "Zé", "ß", " ", "\n", ".", "日本", "😀", "\ud800", "x y z abcdefgh"]) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    for chunk in ([], [""], ["a"], ["é"], texts):
        w = Words(chunk)
        raw = "".join(t.lower() + "\n" for t in chunk).encode("utf-8", "surrogatepass")
        found = [m.span() for m in re.finditer(rb"[0-9a-z\x80-\xff]+", raw)]
        assert list(zip(w.starts.tolist(), w.ends.tolist(), strict=True)) == found
        assert w.letters(w.starts).tolist() == [len(raw[:a].decode("utf-8", "surrogatepass")) for a, _ in found]
    df = spark.createDataFrame([(1, 1, "é\n\nß. Über\nx😀y"), (2, 1, "日本\n-\n本")], "doc long, th long, text string")
    got = units.unit_rows(df, kind, 1, 1).select("doc", "no", "start", "end", "words").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 1, 1), (1, 2, 3, 10, 2), (1, 3, 11, 14, 1), (2, 0, 0, 2, 1), (2, 2, 5, 6, 1)]
    texts = ["Größe und Maß der Dinge, " * 400 + "\n"] * 20
    size, u = len("".join(texts).encode()), kind.units(texts)
    kind.shingles(u)
    tracemalloc.start()
    u = kind.units(texts)
    first, held = tracemalloc.get_traced_memory()[1], tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    kind.shingles(u)
    second = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert first < 20 * size and second < 30 * size
