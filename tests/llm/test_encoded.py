"""Secrets below layers of encodings, resampling by segments, and the Merkle manifest."""

import base64
import bz2
import gzip
import hashlib
import lzma
import math
import random
import re
import zlib
from collections import Counter

import pytest

from rdfweave.llm import merkle, resampling, secrets
from tests.llm.conftest import ODD, PLAIN

PLAIN_KINDS = [
    (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    (r"AKIA[A-Z0-9]+", 0, 20),
    (r"[0-9a-f]+", 0, 24),
]


def plain_scan(text):
    out = []
    for k, (pattern, group, least) in enumerate(PLAIN_KINDS):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(out)


def test_base_kinds_agree():
    rng = random.Random(11)
    parts = ["token", "Secret", "apı_key", "api_key", "APIKEY", "toKen", "ſecret", "=", ":", " ", '"', "'", "abc", "AKIA", "AKIAABCDEFGHIJKL", "0123456789ab", "é", "\n", "-", "Z9"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert secrets.scan(text) == plain_scan(text), text


def percent(raw):
    return "".join(f"%{b:02x}" for b in raw).encode()


WRAPS = {
    "percent": percent,
    "escape": lambda raw: "".join(f"\\u{ord(c):04X}" for c in raw.decode()).encode(),
    "reference": lambda raw: "".join(f"&#{ord(c)};" for c in raw.decode()).encode(),
    "base64": base64.b64encode,
    "url_safe": lambda raw: base64.urlsafe_b64encode(raw).rstrip(b"="),
    "gzip": lambda raw: base64.b64encode(gzip.compress(raw)),
    "zlib": lambda raw: percent(zlib.compress(raw)),
    "bz2": lambda raw: base64.b64encode(bz2.compress(raw)),
    "xz": lambda raw: base64.b64encode(lzma.compress(raw)),
    "twice": lambda raw: base64.b64encode(gzip.compress(bz2.compress(raw))),
}


def test_any_nesting_is_found_at_its_place():
    rng = random.Random(7)
    for _ in range(200):
        raw = b"the api_key: sk-1234567 is here"
        names = [rng.choice(list(WRAPS)) for _ in range(rng.randint(1, 4))]
        for n in names:
            raw = WRAPS[n](raw)
        head = "été\n" + "word " * rng.randint(0, 3)
        text = f"{head}{raw.decode()} end"
        base, every = secrets.secrets(text)
        inner = [(a, b) for a, k, b in every if k == len(secrets.KINDS)]
        # Signs that are decoded one by one give an exact place, all else the place of the whole.
        assert inner and all(len(head) <= a < b <= len(head) + len(raw) for a, b in inner), (names, every)
        assert [s for s in every if s[1] < 3] == base == plain_scan(text)


def test_place_of_partly_encoded_secrets():
    text = "see\nuser password%3Dabc%64efg z %41"
    assert secrets.named(secrets.secrets(text)[1]) == "inner_assign:9:29"
    assert secrets.redacted(text) == "see\nuser [SECRET] z %41"
    assert secrets.secrets("token=abcdef")[1] == [(0, 0, 12)]


def test_layers_end():
    # A layer that holds itself cannot be written down by hand; one that is met twice ends alike.
    same = base64.b64encode(b"token=abcdefgh %41 nothing").decode()
    found = secrets.secrets(f"{same} {same}")[1]
    assert len([s for s in found if s[1] == 3]) == 2
    raw = gzip.compress(b"x", mtime=0)
    assert list(secrets.opened(raw)) == ["x"]
    assert list(secrets.opened(raw, {hashlib.blake2b(raw, digest_size=16).digest()})) == []
    broken = base64.b64encode(gzip.compress(b"token=abcdefgh\n" * 5000)[:-20]).decode()
    assert any(k == 3 for _, k, _ in secrets.secrets(broken)[1])
    for text in ("%" * 50_000, "%41" * 20_000, "a" * 100_000, "token" + " " * 100_000, "&#" * 50_000, "\\u" * 50_000):
        secrets.secrets(text)


def test_much_unpacks_in_pieces():
    raw = b"plain words\n" * 1_000_000 + b"secret = abcdefgh\n"
    parts = list(secrets.opened(gzip.compress(raw)))
    assert "".join(parts).encode() == raw and max(map(len, parts)) < 3 * secrets.PIECE_BYTES
    token = base64.b64encode(gzip.compress(raw)).decode()
    assert secrets.named(secrets.secrets(token)[1]) == f"inner_assign:0:{len(token)}"


def test_secrets_of_odd_rows(shared, frame):
    got = secrets.find(frame(ODD)).collect()
    assert len(got) == len(ODD) and all(r["spans"] == "" or r["n_hex"] for r in got if r["doc_id"] != 7)
    assert secrets.find(frame([])).count() == 0
    clean = secrets.without_secrets(frame([(1, "token=abcdef x"), (2, None), (3, "")]))
    assert clean.columns == frame([]).columns
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {1: "[SECRET] x", 2: None, 3: ""}


NOT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    ws = NOT_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return ws, [" ".join(ws[i : i + k]) for k in (1, 2, 3) for i in range(len(ws) - k + 1)]


def drawn(docs, target, buckets):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(bucket(f) for _, x in docs for f in grams(x)[1]), Counter(bucket(f) for x in target for f in grams(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)}
    rows = []
    for doc_id, x in docs:
        ws, fs = grams(x)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        rows.append((doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(ws) >= 20))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    k = 5 * len(able) // 100
    return sorted([(*r[:4], i + 1 if i < k else None) for i, r in enumerate(able)] + [(*r[:4], None) for r in rows if not r[4]], key=str)


def test_segments_hold_every_feature():
    rng = random.Random(12)
    for _ in range(2000):
        text = "".join(rng.choice(["a", "B", "é ", "\n", "\n", " ", "_", "日 ", "\r\n", "0"]) for _ in range(rng.randint(0, 30)))
        lines = resampling.segments(text.encode())
        got = [b for words in lines for b in resampling.features(words)] + resampling.crossing(lines)
        assert sorted(got) == sorted(zlib.crc32(f.encode()) % resampling.BUCKETS for f in grams(text)[1]), text


@pytest.mark.parametrize("share", [1 / 4096, 1 / 20, 1.0])
def test_resampling_equals_brute_force(shared, frame, monkeypatch, share):
    # With other shares more lines, or none, are looked up apart.
    monkeypatch.setattr(resampling, "HOT_SHARE", share)
    rng = random.Random(13)
    line = ["Common line of the corpus.", "all rights reserved", "x", "one two three four five six", "ÉTÉ 1 2"]
    docs = [(i, "\n".join(rng.choice(line) + (f" {rng.randint(0, 50)}" if rng.random() < 0.5 else "") for _ in range(rng.randint(0, 12)))) for i in range(150)]
    docs += [(r[0], r[1]) for r in ODD] + [(200, "b c " * 400)] * 2
    target = ["one two three four", None, "", "été 1 2 x"]
    got = resampling.resample(frame(docs), shared.createDataFrame([(x,) for x in target], "text string"), buckets=500)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = drawn(docs, target, 500)
    assert sorted([tuple(r) for r in got.collect()], key=str) == want and any(r[4] for r in want)


def test_resampling_of_nothing(shared, frame):
    assert resampling.resample(frame([]), frame([]).select("text")).count() == 0
    assert resampling.resample(frame([(1, PLAIN)]), frame([]).select("text")).count() == 1


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def level_up(nodes, fanout):
    return [H(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]


def expected(docs, fanout):
    """Sorted (doc_id, leaf, subroot, root, proof) by a plain tree."""

    def leaf(r):
        fields = (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append(level_up(levels[-1], fanout))
        return levels

    def proof(levels, i):
        out = ""
        for level in levels[:-1]:
            first = i - i % fanout
            out += "".join(level[first:i] + level[i + 1 : first + fanout])
            i //= fanout
        return out

    groups = {}
    for r in docs:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = [(n, sorted(groups[n]), climb([x[2] for x in sorted(groups[n])])) for n in names]
    top = climb([t[2][-1][0] for t in trees])
    rows = []
    for k, (_, members, levels) in enumerate(trees):
        for i, (known, doc_id, own) in enumerate(members):
            rows.append((doc_id if known else None, own, levels[-1][0], top[-1][0], H(proof(levels, i) + proof(top, k))))
    return sorted(rows, key=str)


@pytest.mark.parametrize("fanout,levels", [(2, 1), (3, 2), (3, 5), (5, 2)])
def test_manifest_equals_a_plain_tree(shared, frame, fanout, levels):
    rows = [(i, f"text {i}\nline", "hot") for i in range(100)] + [(200 + i, "é", f"s{i % 11}") for i in range(30)]
    docs = frame(rows + ODD + [(999, "alone", "日本"), (1000, "x", "")])
    got = merkle.proofs(merkle.manifest(docs, fanout=fanout, levels=levels)).collect()
    assert sorted([tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256")) for r in got], key=str) == expected(docs.collect(), fanout)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)


def test_tampering_shows(shared, frame):
    from pyspark.sql import functions as F

    docs = frame([(i, "a\nb" if i % 2 else "ab", "s" if i % 3 else None) for i in range(40)] + [(100, None)])
    got = merkle.proofs(merkle.manifest(docs, F.replace("text", F.lit("\n"), F.lit("")))).collect()
    assert {r["doc_id"] for r in got if not r["verified"]} == {i for i in range(40) if i % 2}
    assert len({r["root"] for r in got}) == 1


def test_manifest_of_little(shared, frame):
    assert merkle.proofs(merkle.manifest(frame([]))).count() == 0
    row = merkle.proofs(merkle.manifest(frame([(1, "x")]))).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == H()
