"""Compression bands, secret scan and decontamination."""

import base64
import collections
import hashlib
import json
import random
import re
import string

import numpy as np
import pytest
import zstandard

from barloom.llm import decontaminate, quality, secret_scan

SCHEMA = "doc_id long, text string, kept int, spans string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", len(t or "")) for d, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n))


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    trigrams = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if trigrams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in lines
            lines.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), duplicates, len(covered), failed


def test_quality_counts_and_verdicts(spark, monkeypatch):
    rng = random.Random(1)
    words = prose(rng, 400)
    rows = [
        (1, words), (2, None), (3, ""), (4, " \n\t\n"), (5, "few words"), (6, "spam and eggs " * 40),
        (7, words + "\n" + words[:50] + "\n" + words[:50] + "\n \n \nü ß # $ |"), (8, words), (8, words),
        (9, "\n".join(["a line", "a line ", "a line", "", ""]) * 3), (None, words),
        (10, " ".join("".join(rng.choices(string.printable[:94], k=60)) for _ in range(200))),
        (11, prose(rng, 60) + " " + "0" * 60_000), (12, " ".join(f"{i} {'ab' * 30}" for i in range(900))), (13, prose(rng, 20_000)),
    ]
    got = quality.judge(frame(spark, rows)).collect()
    assert [r.doc_id for r in got] == [d for d, _ in rows]
    for row, (_, text) in zip(got, rows):
        assert tuple(row[1:6]) + (row.base_failed,) == counts(text), row
        assert row.kept == (row.reason is None) and (row.kept or row.base_failed or row.reason)
        if text:
            raw = text.encode()
            c = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
            assert row.whole_ratio == pytest.approx(len(c.compress(raw)) / len(raw))
    verdict = {r.doc_id: r.reason for r in got}
    assert verdict[1] is None and verdict[13] is None and verdict[2] == verdict[5] == "words" and verdict[6] == "repeats"
    assert verdict[10] == "incompressible" and verdict[11] == "repetitive" and verdict[12] == "repetitive"


def test_chunks_are_judged_on_their_own(spark):
    rng = random.Random(2)
    vocabulary = prose(rng, 400).split()
    blob = " ".join("".join(rng.choices(string.printable[:94], k=70)) for _ in range(120))
    text = " ".join(rng.choices(vocabulary, k=2800)) + " " + blob
    row = quality.judge(frame(spark, [(1, text)])).first()
    assert row.n_chunks == -(-len(text) // 4096) and row.high_chunks >= 2 and row.low_chunks == 0
    assert row.reason == "incompressible_chunks" and row.whole_ratio < quality.band(quality.Rules(), len(text))[1]
    tail = " ".join(rng.choices(vocabulary, k=1200))[:4096].rstrip() + "x" * 4096
    odd = quality.judge(frame(spark, [(1, tail[:4097])])).first()
    assert odd.n_chunks == 2 and odd.kept  # a chunk of one byte has no limit
    assert quality.judge(frame(spark, [])).count() == 0


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


RNG = random.Random(9)
NUMBER = der(2, b"\x01" + RNG.randbytes(127))
RSA = der(0x30, der(2, b"\0"), *[NUMBER] * 8)
WRAPPED = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, RSA))
EC = der(0x30, der(2, b"\1"), der(4, RNG.randbytes(32)))
PUBLIC = der(0x30, der(0x30, der(6, b"\x2a\x86\x48")), der(3, RNG.randbytes(64)))


def field(raw):
    return len(raw).to_bytes(4, "big") + raw


SSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 40) + field(b"q" * 90)


def url64(value):
    return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")


TOKEN = f"{url64({'alg': 'HS256', 'typ': 'JWT'})}.{url64({'sub': 'someone'})}.c2lnbmF0dXJlLWJ5dGVz"


@pytest.mark.parametrize("raw, kind", [(RSA, "der"), (WRAPPED, "der"), (EC, "der"), (SSH, "ssh"), (PUBLIC, None), (RSA[:-3], None),
                                       (RSA + b"x", None), (SSH[:-1], None), (SSH + b"x", None), (b"", None), (b"\x30\x80", None),
                                       (b"\x30\x84\xff\xff\xff\xff" + b"a" * 40, None), (RNG.randbytes(300), None)])
def test_structures(raw, kind):
    assert secret_scan.key_kind(raw) == kind
    if kind:
        text = base64.b64encode(raw).decode()
        assert [s[0] for s in secret_scan.find(f"id {text} end") if s[0] in ("der", "ssh")] == [kind]
        hexed = raw.hex()
        assert (kind, 3, 3 + len(hexed)) in secret_scan.find("id " + hexed)


def test_tokens_and_blocks():
    assert secret_scan.find(f"see {TOKEN}, ok") == [("token", 4, 4 + len(TOKEN))]
    assert secret_scan.find(TOKEN.replace("eyJ", "abc", 1)) == []
    head = url64({"typ": "JWT"})
    assert secret_scan.find(f"{head}.{url64({'a': 1})}.c2ln") == []
    body = "\n".join(re.findall(".{1,64}", base64.b64encode(WRAPPED).decode()))
    block = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"
    assert ("pem", 1, 1 + len(block)) in secret_scan.find(" " + block)
    assert secret_scan.find(block.replace(body, "bm90IGEga2V5")) == []


@pytest.mark.parametrize("before, after", [("see ", "."), ("see ", ". Then"), ("see ", "..."), ("(", ".)"), ("see ...", " ok"), ("", ".\n")])
def test_tokens_beside_full_stops(before, after):
    assert secret_scan.find(before + TOKEN + after) == [("token", len(before), len(before) + len(TOKEN))]
    assert secret_scan._without(before + TOKEN + after, "[secret]") == f"{before}[secret]{after}"


def test_tokens_of_other_numbers_of_segments():
    assert secret_scan.find(f"{TOKEN}.c2ln") == secret_scan.find(f"ab.{TOKEN}") == secret_scan.find(f"{TOKEN}.c2ln.") == []


HEADED = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0F1E2D3C4B5A69788796A5B4C3D2E1F0\n\n"


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\\n", "\\r\\n", "\\\\n"])
@pytest.mark.parametrize("headers, raw, found", [
    ("", RSA, True), ("", WRAPPED, True), ("", SSH, True), ("", PUBLIC, False), ("", RSA[:-3], False),
    ("Comment: some key\n\n", RSA, True), ("Comment: some key\n\n", RNG.randbytes(320), False),
    (HEADED, RNG.randbytes(320), True), (HEADED, RNG.randbytes(321), False), (HEADED, b"", False),
])
def test_blocks_with_headers_and_escaped_breaks(newline, headers, raw, found):
    body = "\n".join(re.findall(".{1,64}", base64.b64encode(raw).decode()))
    block = f"-----BEGIN RSA PRIVATE KEY-----\n{headers}{body}\n-----END RSA PRIVATE KEY-----".replace("\n", newline)
    text = f'{{"key": "{block}", "n": 1}}'
    at = text.index(block)
    assert [s for s in secret_scan.find(text) if s[0] == "pem"] == ([("pem", at, at + len(block))] if found else [])
    if found:
        assert secret_scan._without(text, "[secret]") == '{"key": "[secret]", "n": 1}'
        two = f"-----BEGIN PRIVATE KEY----- is how it begins. {text} {text}"
        assert sum(s[0] == "pem" for s in secret_scan.find(two)) == 2


def base_spans(text):
    """The base rules, straight from their statement."""
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


SCANS = [
    (1, None), (2, ""), (3, "naïve token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" ü"), (4, "Api_Key:'abcdefghijkl' apikey=short"),
    (5, "token: secret = 'abcdefghijklmnopq'"), (6, "AKIAABCDEFGHIJ AKIAABCDEFGHIJK"), (7, "0123456789abcdef 0123456789ABCDEF"),
    (8, "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop"), (9, TOKEN), (10, base64.b64encode(RSA).decode()), (3, "repeated row"),
    (None, "password=" + "x" * 40), (11, "token" + " " * 5000 + "= abcdefghijklmn"),
]


def test_scan_equals_the_base_rules_and_adds_spans(spark):
    got = secret_scan.digests(secret_scan.scan(frame(spark, SCANS))).collect()
    for row, (doc_id, text) in zip(got, SCANS):
        base = base_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.doc_id == doc_id and row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (row, base)
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == kind for k, _, _ in base) for kind in secret_scan.BASE_KINDS]
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(","))
    assert got[8].spans.startswith("token:0:") and "der:0:" in got[9].spans


def test_redaction_changes_only_what_it_must(spark):
    docs = frame(spark, SCANS)
    got = secret_scan.redact(docs)
    assert got.schema == docs.schema
    for row, (doc_id, text) in zip(got.collect(), SCANS):
        assert row.doc_id == doc_id
        if not text or not secret_scan.find(text):
            assert (row.text, row.n_chars) == (text, len(text or ""))
        else:
            assert not secret_scan.find(row.text) and "[secret]" in row.text and row.n_chars == len(row.text)
    assert secret_scan.scan(frame(spark, [])).count() == secret_scan.redact(frame(spark, [])).count() == 0


BENCH = "item_id long, text string, doc_id string"


def test_leaks_are_found_through_substitutions(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, 30)) for i in range(6)] + [(6, "short item here"), (7, None), (8, ""), (9, prose(rng, 8))]
    texts = dict(items)

    def changed(text, at):
        words = text.split()
        for k in at:
            words[k] = "other"
        return " ".join(words)

    docs = [
        (1, prose(rng, 40) + " " + texts[0] + " " + prose(rng, 9)),
        (2, texts[1] + " " + prose(rng, 5) + " " + texts[2]),
        (3, prose(rng, 20) + " " + changed(texts[3], [7, 15, 22]) + " " + prose(rng, 20)),
        (4, changed(texts[4], [3, 8, 13, 18, 23])),
        (5, " ".join(texts[5].split()[10:24])), (6, " ".join(texts[5].split()[10:20]) + " " + prose(rng, 30)),
        (7, prose(rng, 100)), (8, None), (9, ""), (10, "here is a short item here now"), (11, texts[9] + " more"),
        (12, texts[0]), (12, texts[0]), (None, texts[1]), (13, "a short item"),
    ]
    bench = spark.createDataFrame([(*i, "x") for i in items], BENCH)
    got = decontaminate.overlaps(frame(spark, docs), bench)
    found = {(r.doc_id, r.item_id): r for r in got.collect()}
    assert set(found) == {(1, 0), (2, 1), (2, 2), (3, 3), (4, 4), (5, 5), (10, 6), (11, 9), (12, 0), (None, 1)}
    assert (found[1, 0].start, found[1, 0].n_overlap, found[1, 0].n_equal) == (40, 30, 30)
    assert (found[3, 3].n_overlap, found[3, 3].n_equal) == (30, 27) and found[5, 5].item_start == 10
    small = decontaminate.overlaps(frame(spark, docs), bench, decontaminate.Rules(block_bytes=300))
    assert {(r.doc_id, r.item_id) for r in small.collect()} == set(found)
    clean = decontaminate.clean(frame(spark, docs), bench)
    assert clean.columns == frame(spark, docs).columns
    assert sorted(r.doc_id for r in clean.collect()) == [6, 7, 8, 9, 13]
    assert sorted(r.doc_id for r in decontaminate.clean(frame(spark, docs), bench, decontaminate.Rules(block_bytes=300)).collect()) == [6, 7, 8, 9, 13]


def test_equal_to_brute_force_on_exact_runs(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(10)]
    docs = []
    for d in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 80))
        if d % 3 == 0:
            source, at, n = rng.choice(items)[1].split(), rng.randrange(20), rng.randint(6, 20)
            words[10:10] = source[at : at + n]
        docs.append((d, " ".join(words)))
    runs = set()
    for d, text in docs:
        for i, item in items:
            grams = {tuple(item.split()[p : p + 13]) for p in range(28)}
            words = text.split()
            if any(tuple(words[p : p + 13]) in grams for p in range(len(words) - 12)):
                runs.add((d, i))
    got = decontaminate.overlaps(frame(spark, docs), spark.createDataFrame([(*i, "x") for i in items], BENCH))
    pairs = {(r.doc_id, r.item_id): r.n_equal for r in got.collect()}
    assert runs <= set(pairs) and all(n >= 13 for n in pairs.values())


def qualifying(words, item, rules=decontaminate.Rules()):
    """Whether any stretch of any diagonal reaches the rules, by trying them all."""
    needed = min(rules.least_equal, -(-4 * len(item) // 5))
    for shift in range(-len(item) + 1, len(words)):
        sums = [0]
        for k in range(max(0, -shift), min(len(item), len(words) - shift)):
            sums.append(sums[-1] + (words[k + shift] == item[k]))
        for a in range(len(sums)):
            if any(sums[b] - sums[a] >= needed and 5 * (sums[b] - sums[a]) >= 4 * (b - a) for b in range(a + 1, len(sums))):
                return True
    return False


def substituted(rng, words, share):
    return [f"other{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


def test_more_leaked_text_does_not_hide_a_leak(spark):
    rng = random.Random(12)
    item = prose(rng, 120).split()
    docs = [(1, " ".join(w if k < 20 or k % 4 else "other" for k, w in enumerate(item))), (2, " ".join(item[:20]))]
    bench = spark.createDataFrame([(0, " ".join(item), "x")], BENCH)
    got = {r.doc_id: r for r in decontaminate.overlaps(frame(spark, docs), bench).collect()}
    assert set(got) == {1, 2} and got[1].n_equal >= 20 and 5 * got[1].n_equal >= 4 * got[1].n_overlap
    assert decontaminate.clean(frame(spark, docs), bench).count() == 0


def test_every_overlap_has_a_seed():
    rules = decontaminate.Rules()
    for n in range(4, 21):  # the least item that holds n words asks for the fewest
        patterns = np.arange(1 << n)
        ones = np.bitwise_count(patterns)
        counted = patterns[(ones >= decontaminate._needed(rules, n)) & (5 * ones >= 4 * n)]
        hit = np.zeros(len(counted), bool)
        for mask in rules.masks:
            for shift in range(n - len(mask) + 1):
                looked = int(mask, 2) << shift
                hit |= counted & looked == looked
        assert len(counted) and hit.all(), n


def test_recall_equals_brute_force_under_substitutions(spark):
    rng = random.Random(14)
    cases = []
    for k in range(120):
        item = prose(rng, rng.choice([5, 8, 13, 15, 20, 30, 50, 60])).split()
        if k % 3:
            words = substituted(rng, item, rng.choice([0.1, 0.15, 0.2, 0.25]))
        else:
            phase = rng.randrange(5)
            words = [f"other{i}" if i % 5 == phase else w for i, w in enumerate(item)]
        cases.append((k, prose(rng, 3).split() + words + prose(rng, 3).split(), item))
    docs = frame(spark, [(k, " ".join(words)) for k, words, _ in cases])
    bench = spark.createDataFrame([(k, " ".join(item), "x") for k, _, item in cases], BENCH)
    got = {r.doc_id for r in decontaminate.overlaps(docs, bench).collect() if r.doc_id == r.item_id}
    expected = {k for k, words, item in cases if qualifying(words, item)}
    assert got == expected and 40 < len(expected) < 120


def test_longest_stretch_equals_brute_force():
    rng, rules = random.Random(13), decontaminate.Rules()
    for _ in range(400):
        share = rng.choice([0.1, 0.2, 0.25, 0.4, 0.9])
        equal = [rng.random() >= share for _ in range(rng.randint(1, 40))]
        best = (0, 0, 0)
        for a in range(len(equal)):
            for b in range(a + 1, len(equal) + 1):
                if 5 * sum(equal[a:b]) >= 4 * (b - a):
                    best = max(best, (sum(equal[a:b]), a - b, -a))
        start, end = decontaminate._longest(np.array(equal), rules)
        assert (sum(equal[start:end]), start - end, -start) == best, equal


def test_empty_sides(spark):
    bench, docs = spark.createDataFrame([], BENCH), frame(spark, [(1, "a b c d e f g")])
    assert decontaminate.overlaps(docs, bench).count() == 0 and decontaminate.clean(docs, bench).count() == 1
    assert decontaminate.overlaps(frame(spark, []), spark.createDataFrame([(1, "a b c", "x")], BENCH)).count() == 0
