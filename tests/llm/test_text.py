"""Operators on single texts: rules, personal data, quality, toxicity, pages, tiling."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from rdfweave.llm import boosting, html, pii, quality, rules, tiling, toxicity, words
from tests.llm.conftest import ODD, PLAIN

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    ws = WORD.findall(text)
    places = {}
    for i in range(len(ws) - 7):
        places.setdefault(tuple(ws[i : i + 8]), []).append(i)
    repeat = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))


def test_rules_equal_brute_force():
    rng = random.Random(3)
    texts = ["", " ", "a", "\n\n", "a b c d e f g h " * 4, "é #|x y\x1cz\nA\nA \nA"]
    texts += ["".join(rng.choice("ab\n #é ") for _ in range(rng.randint(0, 200))) for _ in range(200)]
    got = rules.measure([t.encode() for t in texts])
    assert [tuple(int(got[m][i]) for m in rules.MEASURES) for i in range(len(texts))] == [measured(t) for t in texts]


def thue_morse(n):
    """A word and its complement, which every polynomial hash modulo a power of two confuses."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 8192])
def test_texts_of_regular_build(n):
    a, b = thue_morse(n)
    texts = [f"{a}\n{b}\n{a}", f"{a} {b}", " ".join(a) + "\n" + " ".join(b), " ".join([a, b] * 4) + " " + " ".join([b, a] * 4)]
    got = rules.measure([t.encode() for t in texts])
    assert [tuple(int(got[m][i]) for m in rules.MEASURES) for i in range(len(texts))] == [measured(t) for t in texts]


def test_hash_is_a_polynomial_modulo_a_prime():
    rng = random.Random(61)
    p = int(words.PRIME)
    a, b = ([rng.randrange(p) for _ in range(2000)] + [0, 1, p - 1, p - 1] for _ in range(2))
    assert [int(x) for x in words.times(np.array(a, np.uint64), np.array(b, np.uint64))] == [x * y % p for x, y in zip(a, b)]
    # The same stretch has one hash wherever it stands, and however long the buffer is.
    part = "nächste Zeile".encode()
    for before in (0, 1, 5000, (1 << 22) + 3):
        t = words.Text([b"x" * before + part + b"tail"])
        (h,) = t.hashes(np.array([before]), np.array([before + len(part)]))
        plain = sum((c + 1) * pow(words.PRIME_BASE, i, p) for i, c in enumerate(part)) % p
        assert int(h) == int(words.mix(np.array([plain ^ (len(part) << 48)], np.uint64))[0])


def disclosed_plainly(texts):
    """Shares of all (entity, term) pairs, from plain sets and counts."""
    having, holding, together, seen = {}, {}, {}, {}
    for text in texts:
        spans = pii.base_spans(text)
        tokens = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[A-Za-z0-9]+", text)]
        for w in {x for _, _, x in tokens if len(x) >= 3}:
            holding[w] = holding.get(w, 0) + 1
        out = set()
        for e in {(k, v) for a, k, b in spans for v in (text[a:b].lower(), "group " + pii.group_of(k, text[a:b]))}:
            having[e] = having.get(e, 0) + 1
        for a, k, b in spans:
            near = [t for t in tokens if t[1] <= a][-pii.CONTEXT :] + [t for t in tokens if t[0] >= b][: pii.CONTEXT]
            near = [x for s, e, x in near if len(x) >= 3 and not any(s < y and e > z for z, _, y in spans)]
            for v in (text[a:b].lower(), "group " + pii.group_of(k, text[a:b])):
                out |= {((k, v), w, tuple(sorted(near))) for w in near}
        for e, w, context in out:
            together[e, w] = together.get((e, w), 0) + 1
            seen.setdefault((e, w), set()).add(context)
    share = {
        key: 1 + math.log(min(n, holding[key[1]]) / holding[key[1]]) / math.log(max(len(texts) / having[key[0]], 1.0000001))
        for key, n in together.items() if len(seen[key]) >= pii.SUPPORT
    }
    return sorted(0 if x >= pii.REMOVE else 1 for x in share.values() if x >= pii.GENERALISE)


@pytest.mark.parametrize("seed", range(3))
def test_shares_equal_brute_force(shared, frame, seed):
    rng = random.Random(seed)
    word = [f"word{i}" for i in range(60)]
    special = {f"{n}@d{n % 3}.org": [f"name{n}", f"firm{n % 3}"] for n in range(8)}
    texts = []
    for _ in range(200):
        parts = rng.choices(word, k=rng.randint(5, 30))
        if rng.random() < 0.4:
            value = rng.choice(list(special))
            beside = [w for w in special[value] if rng.random() < 0.8] + rng.choices(word, k=2)
            rng.shuffle(beside)
            parts[2:2] = [*beside, value]
        texts.append(" ".join(parts))
    docs = frame(list(enumerate(texts)))
    found = docs.select("doc_id", "text").mapInArrow(pii._found, pii.FOUND)
    got = sorted(r["action"] for r in pii.disclosing(docs, found).collect())
    assert got == disclosed_plainly(texts) and len(got) > 3
    spans = [r["spans"] for r in pii.find(shared, docs).collect()]
    assert any("term:" in s for s in spans)


def test_prior_shrinks_hosts():
    mean, weight = rules.beta_prior(3, 300, 90, 90 * 90 / 100, 3 * 100.0**2)
    assert mean == pytest.approx(0.3) and 1 <= weight < 300
    assert rules.beta_prior(0, 0, 0, 0, 0) == (0.0, 1.0)


def test_host_verdict_reaches_its_documents(shared, frame):
    bad = [(i, "a b", "bad") for i in range(200)] + [(900, PLAIN, "bad"), (901, PLAIN, "good"), (902, PLAIN, None)]
    rows = {r["doc_id"]: r["kept"] for r in rules.judge(shared, frame(bad + [(1000 + i, f"{PLAIN} {i}", "good") for i in range(200)])).collect()}
    assert not rows[900] and not rows[0] and rows[901] and rows[902]


def test_odd_rows_are_judged(shared, frame):
    rows = rules.judge(shared, frame(ODD)).collect()
    assert len(rows) == len(ODD)
    assert {r["doc_id"] for r in rows if r["base_failed"]} >= {1, 2, 3}
    assert rules.judge(shared, frame([])).count() == 0


PERSONAL = [
    ("a@b.c", "email:0:5"),
    ("x a.b+c@mail-1.example.com. y@z", "email:2:26"),
    ("a@b@c.de_f@g.hi", "email:2:8,email:8:15"),
    ("at 10.0.0.255, 10.0.0.256 and 1.2.3.4.5", "ip:3:13,ip:30:37"),
    ("card 4111-1111 11111112 or 4111111111111111!", "card:27:43"),
    ("call +1 (974) 555-3436 now", "phone:5:22"),
    ("é +1234", ""),
]


@pytest.mark.parametrize("text,spans", PERSONAL)
def test_base_spans(text, spans):
    assert pii.named(pii.base_spans(text)) == spans


def test_long_runs_are_read_once():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "a@" * 50_000):
        pii.base_spans(text)


def test_plain_patterns_agree():
    rng = random.Random(5)
    plain = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"]
    for _ in range(3000):
        text = "".join(rng.choice("ab1.@_-+ ") for _ in range(rng.randint(0, 30)))
        assert list(pii.emails(text)) == [m.span() for m in re.finditer(plain[0], text)], text
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in re.finditer(plain[1], text)], text


def test_terms_that_disclose_are_marked(shared, frame):
    names = ["alpha", "bravo", "carol", "delta", "eagle", "fable"]
    filler = [(100 + i, f"{names[i % 6]} walks {names[(i + 1) % 6]} home") for i in range(60)]
    told = [(i, f"{names[i]} wrote that Zebulon uses {names[i + 1]} me@home.org {names[i + 2]} always") for i in range(4)]
    rows = {r["doc_id"]: r for r in pii.find(shared, frame(told + filler)).collect()}
    assert "term:" in rows[0]["spans"] and "email:" in rows[0]["spans"]
    start = told[0][1].index("Zebulon")
    assert f"term:{start}:{start + 7}" in rows[0]["spans"]
    assert all(rows[100 + i]["spans"] == "" for i in range(60))
    assert rows[0]["base_sha256"] == hashlib.sha256(pii.named(pii.base_spans(told[0][1])).encode()).hexdigest()


def test_disclosing_terms_go_from_texts_without_the_value(shared, frame):
    names = ["alpha", "bravo", "carol", "delta", "eagle", "fable"]
    filler = [(100 + i, f"{names[i % 6]} walks {names[(i + 1) % 6]} home") for i in range(600)]
    told = [(i, f"{names[i]} wrote that Zebulon uses {names[i + 1]} me@home.org {names[i + 2]} always") for i in range(4)]
    alone = [(2000, "today Zebulon came"), (None, "today Zebulon came"), (2010, "once Zebulon"), (2010, "two, Zebulon"), (2010, None), (2020, "")]
    spans = [(r["doc_id"], r["spans"]) for r in pii.find(shared, frame(told + filler + alone)).collect() if r["doc_id"] is None or r["doc_id"] >= 2000]
    # Eight texts with the term, four with the value: it discloses 1 - ln 2 / ln 152 = 0.86.
    want = [(2000, "general:6:13"), (None, "general:6:13"), (2010, "general:5:12"), (2010, "general:5:12"), (2010, ""), (2020, "")]
    assert sorted(spans, key=str) == sorted(want, key=str)


def test_personal_data_is_replaced(shared, frame):
    docs = frame([*ODD, (8, "write a@b.cd or +1 (974) 555-3436")])
    clean = pii.without_personal_data(shared, docs)
    assert clean.columns == docs.columns
    rows = [r for r in clean.collect() if r["doc_id"] == 8]
    assert rows[0]["text"] == "write [EMAIL] or [PHONE]" and clean.count() == len(ODD) + 1
    assert pii.sanitised("abcdef", "email:0:3,card:2:5") == "[EMAIL]f"
    assert pii.find(shared, frame([])).count() == 0


def test_personal_data_goes_by_the_text_of_a_row(shared, frame):
    docs = frame([(None, "write a@b.cd"), (None, "quiet"), (3, "from a@b.cd on"), (3, "plain words stay here"), (3, "to c@d.ef"), (3, None)])
    rows = [(r["doc_id"], r["text"]) for r in pii.without_personal_data(shared, docs).collect()]
    want = [(None, "write [EMAIL]"), (None, "quiet"), (3, "from [EMAIL] on"), (3, "plain words stay here"), (3, "to [EMAIL]"), (3, None)]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_trees_learn_and_step_alike():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = boosting.train(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    one = x[1500]
    total = model.start
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + bool(one[feature[node]] > threshold[node])
        total += leaf[node - len(feature)]
    assert model.score(one[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def labelled(shared, frame, toxic=False):
    bad = "you worthless idiot" if toxic else "%%% ### *** $$$ &&&"
    docs = [(i, f"{PLAIN[: 200 + i]} {bad if i % 4 == 0 else 'and so on'} {PLAIN[:100]}") for i in range(400)]
    column = "toxic" if toxic else "quality"
    return frame(docs + [(None, bad), (1000, None), (1001, "")]), shared.createDataFrame(
        [(i, int((i % 4 == 0) == toxic)) for i in range(400)] + [(None, 1), (3, None)], f"doc_id long, {column} int"
    )


@pytest.mark.parametrize("operator,toxic", [(quality, False), (toxicity, True)])
def test_classifiers_on_held_out_rows(shared, frame, operator, toxic):
    docs, labels = labelled(shared, frame, toxic)
    rows = operator.classify(shared, docs, labels).collect()
    assert len(rows) == 403 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 400]
    assert len(held) > 40 and all(r["predicted"] == int((r["doc_id"] % 4 == 0) == toxic) for r in held)
    assert operator.classify(shared, frame([]), labels).count() == 0
    assert operator.classify(shared, docs, labels.limit(0)).count() == 403


def test_toxic_rows_go(shared, frame):
    docs, labels = labelled(shared, frame, True)
    left = toxicity.without_toxic(shared, docs, labels)
    assert left.columns == docs.columns and {r[0] for r in left.select("doc_id").collect() if r[0] is not None and r[0] < 400} == {i for i in range(400) if i % 4}


def test_statistics_of_empty_texts_are_finite():
    assert np.isfinite(quality.statistics([b"", b" ", "é".encode() * 1000])).all()


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><div class="ad">Buy now, only today.</div>
<article><h1>The  title &amp; more</h1><p><b>First line,\n with   space.<br><p>Second &lt;line&gt;, long enough to be read as text.</p></article>
<footer>&copy; someone</footer>"""


def test_page_text(shared):
    pages = shared.createDataFrame([(1, "u", PAGE, "x"), (2, "v", None, "x"), (3, None, "", "x"), (1, "u", PAGE, "x"), (4, "w", "<" * 1000 + "<p>a", "x")], "page_id long, url string, html string, text string")
    rows = html.extract(shared, pages).collect()
    want = "The title & more\nFirst line, with space.\nSecond <line>, long enough to be read as text."
    assert [r["text"] for r in rows if r["page_id"] == 1] == [want, want]
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in rows if r["page_id"] in (2, 3)) and len(rows) == 5
    assert html.extract(shared, pages.limit(0)).count() == 0


def test_marginals_equal_enumeration():
    model = html.fit([html.parse(x) for x in html.LABELLED])
    nodes = html.parse("<div><p>One, two.</p><ul><li><a href=x>Home</a></li></ul><p>Three, four; five.</p></div>")
    unary = model.unary([nodes])
    weights = np.zeros((len(nodes), 2))
    for code in range(2 ** len(nodes)):
        labels = [(code >> i) & 1 for i in range(len(nodes))]
        w = model.start[labels[0]] + sum(unary[i] * labels[i] for i in range(len(nodes)))
        w += sum(model.pair[labels[n.parent], labels[i]] for i, n in enumerate(nodes) if i)
        for i, v in enumerate(labels):
            weights[i, v] += np.exp(w)
    assert model.marginals([nodes])[0] == pytest.approx(weights[:, 1] / weights.sum(1))


def test_held_out_layouts():
    found = total = 0
    for i, page in enumerate(html.LABELLED):
        model = html.fit([html.parse(x) for j, x in enumerate(html.LABELLED) if j % 5 != i % 5])
        nodes = html.parse(page)
        labels = html.implied(nodes)
        for n in nodes:
            n.label = None
        content = model.marginals([nodes])[0]
        for n, p, y in zip(nodes, content, labels, strict=True):
            if n.blocks:
                found, total = found + ((p > 0.5) == (y == 1)), total + 1
    assert found / total > 0.9


def test_tiles_are_greedy_and_do_not_overlap():
    a, b = list(range(100, 112)), list(range(200, 210))
    assert sorted(tiling.tile(a + b, b + [1, 2] + a)) == [(0, 12, 12), (12, 0, 10)]
    assert tiling.tile(a + a, a) == [(0, 0, 12)]
    assert tiling.tile(a[:4], a) == []
    rng = random.Random(2)
    for _ in range(200):
        item, text = ([rng.randint(0, 2) for _ in range(rng.randint(0, 40))] for _ in range(2))
        tiles = tiling.tile(item, text)
        used_i, used_t = set(), set()
        for i, j, k in tiles:
            assert k >= tiling.TILE and item[i : i + k] == text[j : j + k]
            assert not used_i & set(range(i, i + k)) and not used_t & set(range(j, j + k))
            used_i |= set(range(i, i + k))
            used_t |= set(range(j, j + k))
        rest = [(i, j) for i in range(len(item) - 4) for j in range(len(text) - 4) if item[i : i + 5] == text[j : j + 5]]
        assert all(used_i & set(range(i, i + 5)) or used_t & set(range(j, j + 5)) for i, j in rest)


def test_reordered_passages_are_caught(shared, frame):
    item = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix strong jinx potions"
    words = item.split()
    docs = frame([*ODD, (20, f"{PLAIN} {item} {PLAIN}"), (21, f"{PLAIN} {' '.join(words[9:])}. And: {' '.join(words[:9])}"), (22, "quick brown fox jumps over"), (23, item.upper())])
    bench = shared.createDataFrame([(1, item), (1, item), (2, None), (3, "too short")], "item_id long, text string")
    rows = tiling.contaminated(shared, docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_tiles"]) for r in rows) == [(20, 1, 1), (21, 1, 2), (23, 1, 1)]
    left = tiling.without_leaks(shared, docs, bench)
    assert left.columns == docs.columns and left.count() == len(ODD) + 1
    assert tiling.contaminated(shared, docs, bench.limit(0)).count() == 0
