"""Operators on the whole corpus: repeated strings, near duplicates, tokens, packing."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from rdfweave.llm import coder, components, induced, minhash, packing, suffix, tokenfile, tokens
from tests.llm.conftest import ODD, PLAIN


@pytest.mark.parametrize("memory,inner", [(0, 0), (100, 1 << 20), (1 << 20, 1 << 20)])
def test_suffixes_and_common_prefixes(memory, inner):
    rng = random.Random(memory + inner)
    for _ in range(300):
        s = [rng.randint(0, rng.choice([1, 3, 255])) for _ in range(rng.randint(1, 60))]
        s += s[: rng.randint(0, len(s))]
        limit = rng.choice([3, 100])
        got = list(induced.Sorter(np.array(s, np.uint16), limit, memory, inner).by_symbol())[::-1]
        place, prefix = (np.concatenate([g[i] for g in got]).tolist() for i in (0, 1))
        assert sorted(place) == list(range(len(s)))
        for k in range(1, len(place)):
            a, b = (s[p : p + limit] for p in place[k - 1 : k + 1])
            assert a <= b
            assert prefix[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def removed(rows):
    """Brute force: (n_bytes, n_removed, n_spans, sha256) by doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted({(i, t or "") for i, t in rows if i is not None}):
        b = text.encode()
        cover = bytearray(len(b))
        for a in range(len(b) - 99):
            if b[a : a + 100] in seen:
                cover[a : a + 100] = b"\1" * 100
            seen.add(b[a : a + 100])
        kept = bytes(c for c, x in zip(b, cover, strict=True) if not x)
        spans = sum(x and not (i and cover[i - 1]) for i, x in enumerate(cover))
        out[doc_id] = (len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdefgh é"
    block = ["".join(rng.choice(letters) for _ in range(rng.randint(60, 250))) for _ in range(12)]
    docs = [(200 + i, "".join(rng.choice([*block, "ab" * 90, "z" * 130, "x"]) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    return docs + [(300 + i, docs[i][1][: rng.randint(0, 400)]) for i in range(20)]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_strings_equal_brute_force(shared, frame, seed):
    rows = corpus(seed) + ([r[:2] for r in ODD if r[0] != 4] if seed == 1 else [])
    want = removed(rows)
    got = suffix.without_repeats(shared, frame(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]
            assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]


def test_several_texts_under_one_id(shared, frame):
    rng = random.Random(9)
    a, b, c = ("".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(3))
    rows = [(1, a), (2, a), (2, b), (2, c[:120]), (3, c), (3, b[:150] + c), (2, b), (None, a), (4, None), (4, "")]
    # The same documents under numbers of their own, in the order of the hash of their text.
    places = suffix.placed(frame(rows))[0].filter("doc_id IS NOT NULL").dropDuplicates(["place"]).collect()
    want = removed([(r["place"], r["text"]) for r in places])
    texts = {(r["doc_id"], r["text"]): want[r["place"]] for r in places}
    got = suffix.without_repeats(shared, frame(rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got if r["doc_id"]) == sorted(
        (r[0], *texts[r[0], r[1]]) for r in rows if r[0]
    )
    assert all(r["n_removed"] <= r["n_bytes"] for r in got)


def test_a_shard_of_the_query_spills_and_recurs(monkeypatch):
    import pyarrow as pa

    from rdfweave.llm import induced

    rng = random.Random(4)
    word = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    lines = [" ".join(rng.choices(word, k=30)) for _ in range(2000)]
    texts = []
    while sum(map(len, texts)) < 2 * suffix.SHARD_BYTES:
        texts.append((rng.choice(lines) + " " + " ".join(rng.choices(word, k=6)) + " " + rng.choice(lines)[:110]).encode())
    spills, sorters = [], []
    spill, make = induced.Queue._spill, induced.Sorter.__init__
    monkeypatch.setattr(induced.Queue, "_spill", lambda self: (spills.append(self.held), spill(self))[1])
    monkeypatch.setattr(induced.Sorter, "__init__", lambda self, *a, **k: (sorters.append(len(a[0])), make(self, *a, **k))[1])
    n = len(texts)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, np.int64)), pa.array(np.arange(n)), pa.array(np.zeros(n, np.int32)), pa.array(texts, pa.binary())], names=["key", "doc_id", "start", "piece"]
    )
    found = sum(b.num_rows for b in suffix._sorted_shards(iter([batch])))
    assert found > 1000 and len(spills) > 3 and len(sorters) > 1


def test_a_common_line_is_no_shard_of_its_own(shared, frame, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD_BYTES", 3000)
    rng = random.Random(7)
    line = "".join(rng.choice("abcdefgh") for _ in range(130))
    side = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(3, 90)))
    rows = [(i, side() + line + side()) for i in range(120)] + [(500 + i, "z" * n) for i, n in enumerate((130, 900, 5000))] + corpus(3)
    docs = frame(rows)
    levels = list(suffix.dealt(docs.select("doc_id", "text").filter("octet_length(text) >= 100")))
    assert len(levels) > 1
    for _, sort in levels:
        assert sort.groupBy("key").agg({"strings": "sum", "*": "count"}).filter("`sum(strings)` + 100 * (`count(1)` - 1) > 3000").count() == 0
    want = removed(rows)
    for r in suffix.without_repeats(shared, docs).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


def test_documents_are_joined_once_however_often_lines_are_dealt(shared, frame, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD_BYTES", 3000)
    rng = random.Random(8)
    line = "".join(rng.choice("abcdefgh") for _ in range(130))
    side = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(3, 90)))
    rows = [(i, side() + line + side()) for i in range(120)] + corpus(4)
    rows += rows[:3]
    docs, sources, wanted = frame(rows), [], suffix._wanted
    monkeypatch.setattr(suffix, "_wanted", lambda source, found: (sources.append(source), wanted(source, found))[1])
    got = suffix.without_repeats(shared, docs).collect()
    assert len(sources) > 1
    # Later levels cut from staged pieces, each where it lies in its document.
    texts = dict(rows)
    for source in sources[1:]:
        assert "at" in source.columns
        assert all(texts[r["doc_id"]].encode()[r["at"] :].startswith(bytes(r["text"])) for r in source.collect())
    want = removed(rows)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


def test_repeated_rows_and_empty_tables(shared, frame):
    got = suffix.without_repeats(shared, frame([(4, PLAIN), (4, PLAIN), (5, PLAIN), (None, PLAIN)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"] > 0) for r in got) == [(0, False), (4, False), (4, False), (5, True)]
    assert suffix.without_repeats(shared, frame([])).count() == 0


def shingle_set(text, k):
    ws = (text or "").encode().lower().split()
    return frozenset([tuple(ws)] if 0 < len(ws) < k else [tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)])


def groups(rows, k):
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def near_copies(seed, copies, edits):
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randint(0, 10**6))
    rows, first = [], [word() for _ in range(60)]
    for i in range(copies):
        ws = list(first)
        for _ in range(rng.choice(edits)):
            ws[rng.randrange(len(ws))] = word()
        rows.append((i, " ".join(ws)))
    rows += [(1000 + i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(30)]
    return rows + [(2000, "One Two"), (2001, "one  two"), (2002, "one two three"), (2003, ""), (2004, " ")]


@pytest.mark.parametrize("small", [12, 2])
def test_components_equal_brute_force(shared, frame, small, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 7)
    rows = near_copies(small, 50, [0, 1, 1, 2, 3, 4])
    want, sizes = groups(rows, 4)
    got = minhash.near_duplicates(shared, frame(rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_one_of_each_group_stays(shared, frame):
    docs = frame(ODD)
    left = minhash.one_of_each(shared, docs)
    assert left.columns == docs.columns
    # One of all copies stays, under whatever doc_id they are, and without one.
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [1, 2, 3, 4, 6, 7]
    alone = minhash.one_of_each(shared, frame([(None, PLAIN), (None, PLAIN), (None, None), (None, None)]))
    assert sorted(r["text"] or "" for r in alone.collect()) == ["", "", PLAIN]
    assert minhash.one_of_each(shared, frame([])).count() == 0
    assert minhash.near_duplicates(shared, frame([])).count() == 0


def test_several_texts_of_one_id_are_classes_each(shared, frame):
    other = " ".join(f"x{i}" for i in range(60))
    a, b = "".join("ab"[bin(i).count("1") % 2] for i in range(2048)), "".join("ba"[bin(i).count("1") % 2] for i in range(2048))
    rows = [(5, PLAIN), (5, other), (7, PLAIN + " more"), (9, other), (9, "alone"), (3, other), (11, f"{a} x y z"), (12, f"{b} x y z"), (None, PLAIN)]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(shared, frame(rows)).collect()}
    ws = PLAIN.split()
    n, m = len({tuple(ws[i : i + 4]) for i in range(len(ws) - 3)}), 57
    assert got == {
        (5, n, 5, True), (7, n + 1, 5, False), (5, m, 3, False), (9, m, 3, False), (3, m, 3, True), (9, 1, 9, True),
        (11, 1, 11, True), (12, 1, 12, True), (None, n, None, True),
    }


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        found = []
        for _ in range(60):
            common = int(600 * share)
            values = rng.integers(0, 1 << 63, 1200 - common, dtype=np.uint64)
            a, b = values[:600], values[600 - common :]
            h = np.concatenate([np.sort(a), np.sort(b)])
            _, packed = minhash.sketch(np.repeat([0, 1], [600, len(b)]), h, 2)
            found.append(minhash.estimate(packed[:1], packed[1:])[0])
        true = common / (1200 - common)
        assert np.mean(found) == pytest.approx(true, abs=0.03)
        assert min(found) > minhash.least_estimate(true)


def test_long_chains_are_one_component(shared):
    pairs = shared.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(pairs).collect()}
    assert got == dict.fromkeys(range(41), 0) | {100: 100, 101: 100}


TEXTS = ["", " ", "a  b", " lead", "trail ", "x\n y", "\t\n  z　 q", "don't  <|endoftext|> hi", "plain words, here. And\nmore: 12, a1. é, ñ.\nЖизнь ²³ ½ a½",
         "日本語 テスト, 😀 a😀.", "a\xa0b c", "word\x1cword b", "\x85x y", PLAIN, "\n", "a\n\nb", "it's, we'll. o'clock"]


def test_cached_words_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 5)
    encoder = tokens.Encoder()
    want = [e.ids + [tokens.END] for e in encoder.tokenizer.encode_batch_fast(TEXTS, add_special_tokens=False)]
    for _ in range(2):
        assert [encoder.ids(x).tolist() for x in encoder.encode([t.encode() for t in TEXTS])] == want


def test_ids_are_those_of_the_tokenizer_file(shared, frame):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokens.default_path())
    texts = [*TEXTS, "hi <|endoftext|> x", "<|endoftext|>", "a<|endoftext|>b c\nd", "<|endoftext| > x", "one\n<|endoftext|>\ntwo"]
    want = {i: fresh.encode(t, add_special_tokens=False).ids + [tokens.END] for i, t in enumerate(texts)}
    assert want[len(TEXTS)] == [5303, 220, 50256, 2124, tokens.END]
    encoder = tokens.Encoder()
    for _ in range(2):
        assert dict(enumerate(encoder.ids(x).tolist() for x in encoder.encode([t.encode() for t in texts]))) == want
    docs = frame(list(enumerate(texts)))
    files = tokenfile.encode_documents(shared, docs).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in files} == {i: (len(x), crc(x)) for i, x in want.items()}
    pieces = packing.pack_documents(docs, ids=True).collect()
    assert all(crc(want[r["doc_id"]][r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] for r in pieces) and len(pieces) == len(texts)


def test_blocks_come_back():
    rng = np.random.default_rng(4)
    blocks = [rng.integers(0, m, n) for m in (2, 300, 65536) for n in (0, 1, 127, 128, 129, 4096)]
    blocks += [np.full(4096, 65535), np.tile([1, 2, 3, 50000], 1000)]
    payloads = coder.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, coder.decode(payloads, [len(b) for b in blocks]), strict=True))
    # A block is read alone as well, and repetition is cheap.
    assert np.array_equal(coder.decode([payloads[-1]], [4000])[0], blocks[-1]) and len(payloads[-1]) < 1000


def test_two_narrowings_code_an_id(monkeypatch):
    calls, put = [], coder.Encoder.put
    monkeypatch.setattr(coder.Encoder, "put", lambda self, *a: (calls.append(1), put(self, *a))[1])
    blocks = [np.random.default_rng(i).integers(0, 65536, 1000 - 130 * i) for i in (3, 0, 7, 1)]
    payloads = coder.encode(blocks)
    assert len(calls) == 2 * 1000
    assert all(np.array_equal(a, b) for a, b in zip(blocks, coder.decode(payloads, [len(b) for b in blocks]), strict=True))
    # Carries run through full words, and a payload that ends early is no error of its own.
    assert len(coder.decode([p[:8] for p in payloads], [len(b) for b in blocks])[1]) == 1000
    low = coder.Encoder(1, 8)
    low.out[:3], low.next[:], low.low[:], low.range[:] = [5, 0xFFFFFFFF, 0xFFFFFFFF], 3, (1 << 64) - 1, 1 << 40
    low.put(np.array([3], coder.U), np.array([1], coder.U), coder.SHIFT)
    assert np.frombuffer(low.finish()[0], "<u4")[:3].tolist() == [6, 0, 0]


def test_order_0_costs_little_more_than_the_counts_say():
    rng = np.random.default_rng(9)
    pool = rng.choice(50_000, 400, replace=False)
    blocks = [pool[np.minimum(rng.zipf(1.4, 4096) - 1, 399)] for _ in range(4)]
    for block, payload in zip(blocks, coder.encode(blocks), strict=True):
        share = np.unique(block, return_counts=True)[1] / len(block)
        # Up to three bytes for each distinct id and one for its count, as the ids are far apart.
        assert 8 * len(payload) < -4096 * (share * np.log2(share)).sum() + 30 * len(share) + 600
    # Truncated and broken payloads are read to the end, for the checksums to judge.
    for payload in (b"", b"\xff", b"\xff" * 3000, coder.encode(blocks[:1])[0][:500]):
        assert len(coder.decode([payload], [4096])[0]) == 4096


def test_new_words_go_to_the_model_alone(monkeypatch):
    encoder, seen = tokens.Encoder(), []
    whole = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda texts: (seen.extend(texts), whole(texts))[1])
    letters = "one two. \u00e9t\u00e9 \u0416\u0438\u0437\u043d\u044c, \u65e5\u672c\u8a9e \u02b0 \U00010400z\nline\n\u00df"
    want = [*encoder.tokenizer.encode(letters, add_special_tokens=False).ids, tokens.END]
    assert encoder.ids(encoder.encode([letters.encode()])[0]).tolist() == want
    assert sorted(seen) == [",", ".", "one"]  # punctuation, and the first word, which has no space


def test_each_piece_is_looked_up_once(monkeypatch):
    class Counted(dict):
        found = 0

        def __getitem__(self, key):
            Counted.found += 1
            return super().__getitem__(key)

    encoder = tokens.Encoder()
    encoder.words = Counted()
    texts = ["one two\ntwo " * 50 + "end", "two é one", "a \ufffd b"]
    want = [e.ids + [tokens.END] for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [encoder.ids(x).tolist() for x in encoder.encode([t.encode() for t in texts])] == want
    assert Counted.found < 20
    # Bytes that are no UTF-8 are read as before, with a replacement character.
    assert encoder.encode([b"one \xff two"]) == encoder.encode(["one \ufffd two".encode()])


def test_wide_ids_and_damage():
    ids = [np.array([1, 70_000, 2**31, 5]), np.array([2]), np.arange(9000)]
    row = tokenfile.segment(0, 0, [1, 2, 3], ids)
    assert all(np.array_equal(a, b) for a, b in zip(ids, tokenfile.documents(row), strict=True))
    with pytest.raises(ValueError, match="damaged"):
        tokenfile.documents(row | {"payload": b"\xff" * len(row["payload"])})


def ids_of(rows):
    encoder = tokens.Encoder()
    return [(i, encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [tokens.END]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_all_documents_in_order(shared, frame, monkeypatch):
    rows = [r[:2] for r in ODD] + [(50 - i, t) for i, t in enumerate(TEXTS)]
    want, start = [], 0
    for i, ids in sorted(ids_of(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = tokenfile.encode_documents(shared, frame(rows)).collect()
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda r: r[1]) == want
    assert tokenfile.encode_documents(shared, frame([])).count() == 0


def test_packing_is_whole_and_tight(shared, frame):
    rows = [r[:2] for r in ODD] + [(10 + i, " ".join(f"t{j}" for j in range(7 * i))) for i in range(120)]
    got = packing.pack_documents(frame(rows), ids=True).collect()
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append(r)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SIZE
    want = defaultdict(list)
    for i, ids in ids_of(rows):
        for p, (s, n) in enumerate(packing.pieces(len(ids))):
            want[i].append((p, s, n, crc(ids[s : s + n])))
    assert {i: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in v) for i, v in docs.items()} == {i: sorted(v) for i, v in want.items()}
    assert all(crc(np.frombuffer(bytes(r["ids"]), "<u4")) == r["ids_crc32"] for r in got)
    total = sum(r["length"] for r in got)
    assert len(sequences) <= 1.15 * -(-total // packing.SIZE) + 8  # eight packers
    assert packing.pack_documents(frame([])).count() == 0


def test_fullest_bin_closes_first():
    packer = packing.Packer(10, open_bins=2)
    assert [packer.place(n) for n in (7, 4, 5)] == [(0, 0), (1, 0), (1, 4)]
    packer.place(9)  # bins with 3, 1 and 1 tokens free: the last one closes
    assert packer.count == 2 and [packer.place(n)[0] for n in (3, 1)] == [0, 1]
    assert packing.pieces(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)] and packing.pieces(1024) == [(0, 1024)]
