import base64
import collections
import hashlib
import json
import random
import re

from pyspark.sql import functions as F

from siftwork.llm import decontaminate, fingerprints, licenses, native, secrets

from .conftest import frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(n.to_bytes((n.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + body


KEY = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([3 + i]) * 40) for i in range(8)))


def test_secret_base_spans_by_hand(spark):
    t = 'é Password: "abcdefgh1" token=short AKIA1234567890AB AKIAshort ' + "a" * 40 + " api_key = 'ZZZZZZZZ'"
    r = secrets.scan_secrets(frame(spark, [(1, t), (2, None), (3, "")])).orderBy("doc_id").collect()
    spans = [s.split(":") for s in r[0].spans.split(",")]
    assert [(k, t[int(a) : int(b)]) for k, a, b in spans] == [("assign", 'Password: "abcdefgh1'), ("access", "AKIA1234567890AB"), ("hex", "a" * 40), ("assign", "api_key = 'ZZZZZZZZ")]
    assert (r[0].n_assign, r[0].n_access, r[0].n_hex) == (2, 1, 1) and r[0].base_sha256 == hashlib.sha256(r[0].spans.encode()).hexdigest()
    assert r[1].spans == "" == r[2].spans and r[1].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_structures_are_confirmed_or_refused(spark):
    url = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    b64 = base64.b64encode(KEY).decode()
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(b64[i : i + 64] for i in range(0, len(b64), 64)) + "\n-----END RSA PRIVATE KEY-----"
    jwt = f"{url({'alg': 'HS256'})}.{url({'sub': 'x'})}.c2ln"
    bad = f"{url({'typ': 'JWT'})}.{url({'sub': 'x'})}.c2ln"
    broken = base64.b64encode(KEY[:-3]).decode()
    got = [r.spans for r in secrets.scan_secrets(frame(spark, [(1, "x " + pem), (2, jwt), (3, bad), (4, b64), (5, broken), (6, KEY.hex().upper())])).orderBy("doc_id").collect()]
    assert got[0] == f"pem:2:{2 + len(pem)}" and got[1] == f"jwt:0:{len(jwt)}" and got[2] == "" and got[3] == f"key:0:{len(b64)}" and got[4] == "" and f"hexkey:0:{2 * len(KEY)}" in got[5]


def test_short_and_wrapped_keys_are_confirmed():
    for n in (14, 24, 32):
        short = der(0x30, der(2, b"\1") + der(4, bytes(range(1, n + 1))))
        b64 = base64.b64encode(short).decode()
        assert ("key", 2, 2 + len(b64)) in secrets.confirmed_spans(f"x {b64} y")
        assert ("hexkey", 2, 2 + 2 * len(short)) in secrets.confirmed_spans(f"x {short.hex()} y")
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + b"\0\0\0\1" + b"k" * 150
    for raw, kind, text in ((KEY, "key", base64.b64encode(KEY).decode()), (KEY, "hexkey", KEY.hex()), (ssh, "key", base64.b64encode(ssh).decode())):
        for width, gap in ((64, "\n"), (76, "\r\n    ")):
            body = gap.join(text[i : i + width] for i in range(0, len(text), width))
            for before, after in (("", ""), ("the key\nfollows\n", ".\nEnd of it"), ("private: ", "\n\nbye")):
                found = [x for x in secrets.confirmed_spans(before + body + after) if x[0] == kind]
                assert found == [(kind, len(before), len(before) + len(body))], (kind, width, before, found)
    broken = base64.b64encode(KEY[:-3]).decode()
    assert not secrets.confirmed_spans("\n".join(broken[i : i + 64] for i in range(0, len(broken), 64)))


def test_scans_handle_awkward_rows(awkward, nothing):
    df, rows = awkward
    for f in (secrets.scan_secrets, licenses.scan_licenses, fingerprints.fingerprint_documents):
        assert f(df).count() == len(rows) and f(nothing).count() == 0


def test_license_phrases_against_brute_force(spark):
    texts = ["Apache License, MIT-license; cc by cc by", "gnu general public license gnu GENERAL", "cc. by the mit", None, "", "Kapache license", "apache apache license mit mit license " * 50]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        w = words(t)
        hits = [(k, label) for label, p in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(hits), ",".join(sorted({x for _, x in hits})))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))


def test_license_notices_stand_small_edits(spark):
    notice = dict((l, t) for l, t in licenses.NOTICES)["bsd"].split()
    edited = notice[:6] + ["also"] + notice[6:12] + notice[13:]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, [(1, "intro " + " ".join(edited)), (2, " ".join(notice[:5]))])).collect()}
    assert got[1].labels == "bsd" and got[1].base_labels == "" and 0.6 <= got[1].score <= 1
    assert got[2].labels == "" and 0 < got[2].score < 0.6


def test_overlaps_against_brute_force(spark, prose):
    items = [prose(40) for _ in range(6)] + [prose(6)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(99, None), (0, items[0])], "item_id long, text string")
    swapped = items[1].split()
    swapped[9], swapped[25] = "other", "words"
    rows = [(1, prose(30) + " " + items[0] + " " + prose(10)), (2, " ".join(swapped)), (3, prose(200)), (4, None), (5, " ".join(items[2].split()[:8]) + " " + prose(40)), (6, items[3].upper()), (6, items[3].upper()), (7, items[6]), (8, " ".join(items[4].split()[10:34]))]
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.find_overlaps(frame(spark, rows), bench).collect())
    assert got == {(1, 0): 1, (2, 1): 1, (6, 3): 2, (8, 4): 1}
    blocks = decontaminate.find_overlaps(frame(spark, rows), bench, block_rows=50)
    assert collections.Counter((r.doc_id, r.item_id) for r in blocks.collect()) == got
    kept = decontaminate.drop_contaminated(frame(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7] and kept.columns == frame(spark, rows).columns


def test_overlaps_of_empty_tables(spark, nothing, awkward):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_overlaps(awkward[0], bench).count() == 0
    assert decontaminate.find_overlaps(nothing, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_fingerprints_estimate_generalised_jaccard(spark, prose):
    base = [prose(300) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100, base[0]), (101, None), (102, "")]
    got = sorted(fingerprints.fingerprint_documents(frame(spark, rows)).collect(), key=lambda r: r.doc_id)
    texts, error = [t or "" for _, t in rows], []
    for i, r in enumerate(got):
        nxt, half = texts[(i + 1) % len(texts)], len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + nxt[:half]
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = collections.Counter(words(texts[i])), collections.Counter(words(edited))
        if a or b:
            error.append(r.near_edited - sum((a & b).values()) / sum((a | b).values()))
    assert abs(sum(error)) / len(error) < 0.02 and max(map(abs, error)) < 0.2
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[100].fingerprint and set(by[101].fingerprint) == {"0"} and by[101].near_edited == 1.0 and by[101].near_next == 1.0


def test_fingerprints_of_heavy_words_and_of_few(spark):
    """The collision rate is the generalised Jaccard where one word carries most of the weight."""
    heavy, many, cases = 900, 300, []
    for k in range(6):
        shared, mine, yours = (" ".join(f"{p}{k}x{j}" for j in range(many)) for p in "smy")
        cases += [((shared + f" a{k}" * heavy, shared + f" b{k}" * heavy), many / (many + 2 * heavy)), ((mine + f" c{k}" * heavy, yours + f" c{k}" * heavy), heavy / (heavy + 2 * many))]
        cases += [((f"p{k} q{k} q{k}", f"p{k} q{k} r{k}"), 0.5), ((f"u{k}", f"u{k} u{k} u{k} v{k}"), 0.25)]
    rows = [(i, t) for i, t in enumerate(t for pair, _ in cases for t in pair)]
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(frame(spark, rows)).collect()}
    assert all("0000" not in [r.fingerprint[i : i + 4] for i in range(0, 512, 4)] for r in got.values())
    for kind in range(4):
        seen = [(got[2 * i].near_next, want) for i, (_, want) in enumerate(cases) if i % 4 == kind]
        assert abs(sum(a for a, _ in seen) / len(seen) - seen[0][1]) < 0.06 and all(abs(a - b) < 0.2 for a, b in seen)


def test_words_lower_case_a_to_z_alone(spark):
    """Whatever else stands in the text: a capital K, the Kelvin sign, a dotted I, letters of late Unicode versions."""
    cased = ["\u00c9cole \u00c9t\u00e9", "\u0130stanbul", "\u212aelvin", "\u2168 \u24b6", "\u01c5 \u1c89", "\u03a3\u03a3"]
    texts = [f"{a} {b} Word-Ok".strip() for a in cased for b in ("", "K", "k \u212a", "\u0130", "ABC")] + ["plain ASCII K", "caf\u00e9 K"]
    got = spark.createDataFrame(list(enumerate(texts)), "id long, t string").select("id", native.words_of(F.col("t")).alias("w")).collect()
    assert all(r.w == words(texts[r.id]) for r in got)
    item = " ".join(f"\u00c9t\u00e9{i} \u00c0la{i}" for i in range(12))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.find_overlaps(frame(spark, [(1, item), (2, item + " K"), (3, "K " + item + " x")]), bench).collect()} == {1, 2, 3}
    near = {r.doc_id: r.near_next for r in fingerprints.fingerprint_documents(frame(spark, [(1, item), (2, item + " K")])).collect()}
    assert near[1] > 0.8


def test_fingerprints_are_unbiased(spark):
    """Mean and spread of the error as of 128 independent samples, for near_edited and near_next.

    Each pair of documents has words of its own, so that the pairs' errors are independent.
    """
    rnd = random.Random(8)
    rows = [(i, " ".join(f"w{i // 2}x{w}" for w in rnd.choices(range(rnd.choice((20, 80, 400))), k=rnd.choice((15, 60, 300))))) for i in range(400)]
    got = sorted(fingerprints.fingerprint_documents(frame(spark, rows)).collect(), key=lambda r: r.doc_id)
    errors, expected = [], []
    for i, r in enumerate(got):
        t, nxt = rows[i][1], rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        for seen, other in ((r.near_edited, t[: len(t) - half] + nxt[:half]), (r.near_next, nxt)):
            a, b = collections.Counter(words(t)), collections.Counter(words(other))
            j = sum((a & b).values()) / sum((a | b).values())
            errors.append(seen - j)
            expected.append(j * (1 - j) / 128)
    n = len(errors)
    assert abs(sum(errors) / n) <= 0.005
    assert (sum(e * e for e in errors) / n) ** 0.5 <= 1.25 * (sum(expected) / n) ** 0.5
