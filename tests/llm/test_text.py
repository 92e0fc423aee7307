"""Encoding, token files, extraction and the trained models, against brute force, round trips and held-out labels."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from alula.llm import language_id, licenses, main_text, mixing, passages, pieces, token_files
from alula.llm.common import held_out

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def piece_model():
    with open(PIECES, "rb") as f:
        return pieces.PieceModel(f.read())


def _best_score(model, text):
    marked = "▁" + text.replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(marked)
    for j in range(1, len(marked) + 1):
        for i in range(max(0, j - 20), j):
            if marked[i:j] in model.scores:
                best[j] = max(best[j], best[i] + model.scores[marked[i:j]][1])
        if marked[j - 1] not in model.single:
            best[j] = max(best[j], best[j - 1] + model.fallback)
    return best[-1]


def _score(model, ids):
    known, at, total = {i: s for i, s in model.scores.values()}, 0, 0.0
    while at < len(ids):
        if ids[at] in known:
            total, at = total + known[ids[at]], at + 1
        else:
            lead = model.table[ids[at]][0]
            total, at = total + model.fallback, at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
    return total


def test_segmentation_has_the_best_score_and_decodes(piece_model, monkeypatch):
    monkeypatch.setattr(pieces, "SPAN", 7)
    rng = random.Random(1)
    parts = ["a", "the", "of ", " ", "  ", "\n", "\n ", " \n", "é", "ß", "ing", "tion", "😀", "①", "x", ".", "Q", "\t", "\x00"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        ids = piece_model.encode(text).tolist()
        assert piece_model.decode(np.array(ids)) == text
        assert abs(_score(piece_model, ids) - _best_score(piece_model, text)) < 1e-3
    for text in ("", "▁", "a▁ ▁b\n▁", "x" * 5000):
        assert piece_model.decode(piece_model.encode(text)) == text


def test_pieces_of_a_table(documents):
    docs = documents([(1, "The cat sat.\nIt  sat"), (2, None), (3, ""), (None, "▁ü"), (1, "The cat sat.\nIt  sat")])
    found = pieces.encode_pieces(docs, PIECES, ["doc_id", "score"])
    assert all(r["__round_trip"] for r in found.collect())
    texts = pieces.decode_pieces(found, PIECES, "__pieces", ["doc_id"]).collect()
    assert sorted(r["__text"] for r in texts) == sorted(["The cat sat.\nIt  sat", "The cat sat.\nIt  sat", "", "", "▁ü"])


def test_codes_are_read_at_any_position():
    rng = np.random.default_rng(2)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = np.where(rng.random(n) < 0.5, rng.integers(0, 256, n), np.where(rng.random(n) < 0.7, rng.integers(0, 1 << 16, n), rng.integers(0, 1 << 32, n))).astype(np.uint32)
        reader = token_files.DacReader(token_files.dac_encode(ids))
        assert len(reader) == n and (reader.read(0, n) == ids).all()
        for _ in range(40 if n else 0):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert (reader.read(a, b) == ids[a:b]).all()
            assert reader[min(a, n - 1)] == ids[min(a, n - 1)]


def test_token_files_hold_what_the_library_gives(documents, spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "SEGMENT_IDS", 300)
    rng = random.Random(7)
    odd = ["don't", "Ünïcode", "éa", "<|endoftext|>", "a<|startoftext|>b", "３4", "x\x1cy", " ", " z", "😀!!", "'re", "ΣΑΣ", "\x85"]
    texts = [" ".join(rng.choice(odd + ["the", "of", "Word", "thing,"]) for _ in range(rng.randint(0, 200))) for _ in range(40)]
    rows = [(i * 7 % 41, t) for i, t in enumerate(texts)] + [(-5, None), (100, ""), (50, "again"), (50, "once")]
    t = Tokenizer.from_file(WORDS)
    expected, start = [], 0
    for i, text in sorted((i, x or "") for i, x in rows):
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [1], dtype="<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    path = token_files.write_token_files(documents(rows), WORDS)
    segments = token_files.read_token_files(spark, path)
    assert sorted(map(tuple, token_files.stored_documents(segments).collect()), key=lambda r: r[1]) == expected
    full = token_files.stored_documents(segments, with_ids=True).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in full)
    assert token_files.stored_documents(token_files.read_token_files(spark, token_files.write_token_files(documents([]), WORDS))).count() == 0


def _page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_main_text_of_a_host(spark):
    article = "<article><h1>Head &amp; tail</h1><p>First <b>bo</b>ld<br>line.<p>Second&nbsp;one</p></article>"
    noise = '<nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy</div>'
    rows = [
        (1, "http://a.org/1", _page(noise + article + "<footer>&copy;</footer>")),
        (2, "http://A.org:80/2", _page(noise + article + '<section id="comments"><p>' + "me too " * 80 + "</p></section>")),
        (3, "https://u@a.org?x", _page('<div class="post-9"><p>Other layout of some length</p><aside>side</aside></div><script>if (a<b) {}')),
        (4, None, None), (5, "nonsense", ""), (6, "http://b.org", "just text < here"), (7, "http://b.org", "<p>open<p>para<div class='cookie-notice'>no</div>"),
        (8, "http://b.org", "<form><p>all form</p></form>"), (9, "http://b.org", "<!-- never closed <p>x</p>"), (9, "http://b.org", "<p hidden>h</p><p>s</p>"),
    ]
    df = spark.createDataFrame([(*r, "t", 0) for r in rows], "page_id long, url string, html string, text string, host int")
    found = sorted((r["page_id"], r["__text"], r["__n_chars"]) for r in main_text.main_texts(df, ["page_id", "url", "text", "host"]).collect())
    words = "Head & tail First bold line. Second one"
    texts = [(1, words), (2, words), (3, "Other layout of some length"), (4, ""), (5, ""), (6, "just text < here"), (7, "open para"), (8, ""), (9, ""), (9, "s")]
    assert found == sorted((i, t, len(t)) for i, t in texts)
    assert main_text.main_texts(df.limit(0), ["page_id"]).count() == 0


def test_votes_of_the_host_decide(spark):
    common = '<div class="content"><p>' + "word " * 30 + "</p></div>"
    odd = '<div class="content"><p>short but right</p></div><div class="box"><p>' + "filler " * 60 + "</p></div>"
    rows = [(i, "http://h.org/x", _page(common)) for i in range(5)] + [(9, "http://h.org/y", _page(odd))]
    found = main_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"), ["page_id"])
    assert found.where("page_id = 9").first()["__text"] == "short but right"


class _Tree:
    """An element of a made-up page: what the plain reader below walks, and the markup that the operator reads."""

    def __init__(self, rng, depth=0):
        self.tag = rng.choice(["div", "div", "section", "article", "ul", "nav", "p"]) if depth else "body"
        self.classes = [rng.choice(["box", "col2", "col7", "story", "ad", "x-y"]) for _ in range(rng.choice([0, 1, 1]))] if depth else []
        self.children = []
        for _ in range(rng.randint(1, 3)):
            kind = rng.random()
            if kind < 0.5 or depth > 2 or self.tag == "p":
                word = rng.choice(["ka", "lomi", "strigrund"]) * rng.randint(1, 6)
                self.children.append((rng.choice(["", "", "b", "a"]), word))
            else:
                self.children.append(_Tree(rng, depth + 1))

    def markup(self):
        inner = "".join(c.markup() if isinstance(c, _Tree) else f"<{c[0]}>{c[1]}</{c[0]}>" if c[0] else f" {c[1]} " for c in self.children)
        return f"<{self.tag} class='{' '.join(self.classes)}'>{inner}</{self.tag}>"

    def label(self):
        return ".".join([self.tag, *sorted(c.strip("27") for c in self.classes)])

    def dropped(self):
        return self.tag == "nav" or ("ad" in self.classes and self.tag != "article")

    def mass(self):
        return 0 if self.dropped() else sum(c.mass() if isinstance(c, _Tree) else len(c[1]) * (c[0] != "a") for c in self.children)

    def text(self):
        if self.dropped():
            return " "
        return " " + "".join(c.text() if isinstance(c, _Tree) else c[1] if c[0] else f" {c[1]} " for c in self.children) + " "

    def nodes(self, above):
        path = f"{above}>{self.label()}"
        yield path, self
        if not self.dropped():
            for c in self.children:
                if isinstance(c, _Tree):
                    yield from c.nodes(path)

    def scores(self):
        premium = {"body": 0.5, "article": 1.5}
        found = {"": self.mass() * 0.5, ">html": self.mass() * 0.5}
        for path, node in self.nodes(">html"):
            if node.mass() and node.tag not in ("p", "ul"):
                factor = premium.get(node.tag, 1.25 if "story" in node.classes else 1.0)
                found[path] = found.get(path, 0) + node.mass() * factor
        return {k: v for k, v in found.items() if v}

    def at(self, path):
        if path in ("", ">html"):
            return " ".join(self.text().split())
        hits = [(k, n) for k, n in self.nodes(">html") if k == path]
        return " ".join("".join(n.text() for _, n in hits).split())


def test_pages_of_large_hosts_against_a_plain_reader(spark):
    """Hosts of 20 to 500 random pages: rare paths have their votes counted like frequent ones."""
    rng = random.Random(22)
    trees = [(i, f"http://h{min(i // 500, 1 + i % 3)}.org/{i}", _Tree(rng)) for i in range(700)]
    host = {i: url.split("/")[2] for i, url, _ in trees}
    votes, sums = {}, {}
    for i, _, tree in trees:
        scores = tree.scores()
        if scores:
            best = min(scores, key=lambda p: (-scores[p], -p.count(">"), p))
            key = host[i], best
            votes[key], sums[key] = votes.get(key, 0) + 1, sums.get(key, 0) + scores[best]
    expected = {}
    for i, _, tree in trees:
        own = [p for p in tree.scores() if (host[i], p) in votes]
        expected[i] = tree.at(min(own, key=lambda p: (-votes[host[i], p], -sums[host[i], p], p))) if own else ""
    df = spark.createDataFrame([(i, u, f"<html>{t.markup()}</html>") for i, u, t in trees], "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["__text"] for r in main_text.main_texts(df, ["page_id"]).collect()}
    assert got == expected
    seen = {}
    for (h, _), n in votes.items():
        seen[h] = seen.get(h, 0) + n
    assert any(n < main_text.FREQUENT * seen[h] for (h, _), n in votes.items())


SYLLABLES = {"xx": ["ka", "lo", "mi"], "yy": ["stri", "grund", "ach"], "zz": ["ção", "inho", "ões"]}


def _speech(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_languages_are_told_apart(documents):
    rng = random.Random(9)
    rows = [(i, _speech(rng, lang := rng.choice(list(SYLLABLES)), rng.randint(3, 40)), lang) for i in range(300)]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "123 !!", "zz"), (903, "ka lo mi " * 40_000, None), (None, "ka", "xx"), (904, "ЖЖЖ", None)]
    docs = documents(rows)
    model = language_id.train_language_id(docs, ~held_out(F.col("doc_id")))
    got = {r["doc_id"]: (r["__lang_pred"], r["__score"]) for r in language_id.identify_languages(docs, model, ["doc_id", "score"]).collect()}
    tested = [r for r in rows[:300] if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([got[r[0]][0] == r[2] for r in tested]) > 0.98
    assert [got[i][0] for i in (900, 901, 902, 903)] == ["und", "und", "und", "xx"]
    assert all(0 <= s <= 1 for _, s in got.values())
    empty = language_id.train_language_id(documents([]), F.lit(True))
    assert {r["__lang_pred"] for r in language_id.identify_languages(docs, empty, ["doc_id"]).collect()} == {"und"}


@pytest.mark.parametrize("languages", [["xx"], ["xx", "yy"], ["xx", "yy", "zz"]])
def test_texts_in_no_learnt_language_are_rejected(documents, spark, languages):
    import corpus_pipeline

    rng = random.Random(15)
    rows = [(i, _speech(rng, lang := languages[i % len(languages)], rng.randint(3, 40)), lang) for i in range(240)]
    both = " ".join(_speech(rng, x, 60) for x in languages)
    rows += [(500, both, None), (501, rows[0][1] + "\nReleased under the MIT License.", None), (502, _speech(rng, "xx", 3), None)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    foreign = [
        " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(40)), "qwx vbz jjpq wvf " * 30,
        "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。" * 3, "Все люди рождаются свободными и равными в своем достоинстве и правах.", "ЖЖЖ",
        "".join(rng.sample(list(both), len(both))) if len(languages) > 1 else "dfg " * 40,
    ]
    docs = documents(rows + [(1000 + i, x, "xx") for i, x in enumerate(foreign[:1])] + [(1001 + i, x) for i, x in enumerate(foreign[1:])])
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in rows)


def test_kernel_is_shared_ngram_presence():
    model = language_id.fit_spectrum(["kalo mi", "strich grund"], ["a", "b"])
    x = language_id.presence(["kalo mi", "grund kalo", "KALO, MI!!"], model.ready())
    assert np.allclose((x * x).sum(axis=1), 1)
    assert np.allclose(x[0], x[2])
    sets = [{g for g in range(len(model.slots)) if row[g]} for row in x]
    assert np.isclose(x[0] @ x[1], len(sets[0] & sets[1]) / (len(sets[0]) * len(sets[1])) ** 0.5)


#: Letters and marks of scripts; two languages of each differ in the order in which they join them.
SCRIPTS = {"latin": "abcdefghijklmnopqrstuvwxyzäöüéèñßçàâ", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "indic": "कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह"}
MARKS = "ािीुूेैोौं्"


def _plain_grams(text):
    """The 1-, 2- and 3-grams of letters and single blanks, as a set of strings."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = f" {' '.join(kept.split())} "
    return {padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)}


def test_landmarks_on_every_text_give_dense_kernel_ridge():
    """With every sample text a landmark, nothing is approximated: a plain n x n ridge on shared n-grams decides alike."""
    rng = random.Random(23)
    sample = [(lang, _speech(rng, lang, 8)) for _ in range(12) for lang in SYLLABLES]
    texts, labels = [x for _, x in sample], [lang for lang, _ in sample]
    model = language_id.fit_spectrum(texts, labels, landmarks=3 * len(texts))
    sets = [_plain_grams(t) for t in texts]
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    dense = np.array([[kernel(a, b) for b in sets] for a in sets])
    rank = np.linalg.matrix_rank(dense, tol=1e-8 * np.linalg.eigvalsh(dense)[-1])
    penalty = language_id.RIDGE * len(texts) / (rank + 1)
    n = len(texts)
    system = np.block([[dense + penalty * np.eye(n), np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
    signs = np.array([[1.0 if x == c else -1.0 for c in model.languages] for x in labels])
    solved = np.linalg.solve(system, np.vstack([signs, np.zeros((1, len(model.languages)))]))
    fresh = [_speech(rng, lang, k) for lang in SYLLABLES for k in (1, 3, 9)] + [_speech(rng, "xx", 4) + " " + _speech(rng, "yy", 4)]
    known = set().union(*sets)
    rows = []
    for t in fresh:
        grams = _plain_grams(t) & known  # n-grams that no landmark has are not in the rows' length
        rows.append([len(grams & s) / (len(grams) * len(s)) ** 0.5 for s in sets])
    expected = np.array(rows) @ solved[:-1] + solved[-1]
    got = language_id.presence(fresh, model) @ model.weights[:-1] + model.weights[-1]
    assert np.allclose(got, expected, atol=2e-3)
    assert [model.languages[k] for k in expected.argmax(axis=1)] == language_id.predict_language(fresh, model)[0]


def test_two_languages_in_each_of_four_scripts():
    rng = random.Random(17)
    words = {}
    for k, (script, letters) in enumerate(SCRIPTS.items()):
        for half in "ab":
            pool = random.Random(100 * k + ord(half))
            made = ["".join(pool.choice(letters) + ("" if script != "indic" else MARKS[pool.randrange(len(MARKS))]) for _ in range(2)) for _ in range(12)]
            words[f"{script}-{half}"] = made
    words |= {f"indic-{half}": [c + m for c in SCRIPTS["indic"][:6] for m in marks] for half, marks in (("a", MARKS[:3]), ("b", MARKS[3:6]))}

    def said(lang):
        return " ".join(rng.choice(words[lang]) + rng.choice(words[lang]) for _ in range(12))

    sample = [(lang, said(lang)) for _ in range(40) for lang in words]
    model = language_id.fit_spectrum([x for _, x in sample], [lang for lang, _ in sample])
    fresh = [(lang, said(lang)) for _ in range(20) for lang in words]
    langs, scores = language_id.predict_language([x for _, x in fresh], model)
    assert np.mean([got == lang for got, (lang, _) in zip(langs, fresh)]) > 0.99 and (scores > 0).all()


def test_codes_are_found_in_the_slot_table():
    rng = np.random.default_rng(18)
    codes = np.unique(rng.integers(0, 1 << 62, 5000))
    table = language_id.SlotTable(codes[::2])
    assert (table[codes[::2]] == np.arange(len(codes[::2]))).all() and (table[codes[1::2]] == -1).all()
    assert (language_id.SlotTable(codes[:0])[codes] == -1).all()


def test_quality_is_learnt_from_labels(documents, spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(240):
        good = rng.random() < 0.6
        text = ". ".join(_speech(rng, "xx", 12) for _ in range(rng.randint(1, 60)))
        if not good:
            at = len(text) // 3
            text = text[:at] + " ".join(w + "###" for w in text[at:].split())
        rows.append((i, text))
        labels.append((i, int(good)))
    docs = documents([*rows, (900, None), (901, ""), (None, "ka")])
    table = spark.createDataFrame([*labels, (5, None), (None, 1), (7777, 1)], "doc_id long, label int")
    model = passages.train_quality(docs, table.where(~held_out(F.col("doc_id"))))
    got = {r["doc_id"]: r["__score"] for r in passages.score_quality(docs, model, ["doc_id"]).collect()}
    tested = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == y for i, y in tested]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]
    none = passages.train_quality(docs, table.limit(0))
    assert {r["__score"] for r in passages.score_quality(docs, none, ["doc_id"]).collect()} == {0.5}


def test_attention_gradients_and_passages():
    text = "word " * 5000
    bags = passages.encode(text)
    assert 45 <= len(bags) <= 55 and passages.encode(None).shape == passages.encode("").shape == (1, passages.FEATURES)
    assert len(passages.encode("x" * 2000)) == 4
    model = passages.fit_attention([passages.encode("a b c. " * 50), passages.encode("### $$$ " * 50)] * 20, [1, 0] * 20)
    f = model.forward(np.concatenate([bags, bags[:3]]), np.array([0] * len(bags) + [1] * 3), 2)
    assert np.allclose(np.add.reduceat(f["a"], [0, len(bags)]), 1)


def test_gradients_of_every_weight():
    """Differences of the loss for a small change of each weight, one at a time."""
    texts = ["ka lo mi. " * 150, "### $$ " * 30, "", "Lo mi 77, ka! " * 90]
    bags = [passages.encode(t).astype(np.float64) for t in texts]
    model = passages.fit_attention(bags * 8, [1, 0, 0, 1] * 8, rounds=2)
    x, owner, truth = np.concatenate(bags), np.repeat(np.arange(4), [len(b) for b in bags]), np.array([1.0, 0.0, 1.0, 0.0])
    assert len(bags[0]) > 1

    def loss():
        y = model.forward(x, owner, 4)["y"]
        return -(truth * np.log(y) + (1 - truth) * np.log(1 - y)).mean()

    found = model.gradients(x, owner, truth)
    for name, gradient in found.items():
        w = model.weights[name] = np.array(model.weights[name], dtype=np.float64)
        numeric = np.zeros(w.size)
        for k in range(w.size):
            at = np.unravel_index(k, w.shape)
            old = float(w[at])
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            numeric[k] = (up - loss()) / 2e-5
            w[at] = old
        assert np.allclose(numeric, np.ravel(gradient), atol=1e-7, rtol=1e-4), name


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(12)
    p = rng.dirichlet([0.4, 0.4, 0.4], 500)
    tokens = rng.integers(0, 200, 500)
    df = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "__n_tokens long, __posterior array<double>")
    fit = mixing.fit_rates(df, ["a", "b", "c"], {"a": 0.7, "b": 0.2, "c": 0.1})
    rates = fit.points(p)[0]
    got = (rates * tokens) @ p / tokens.sum()
    assert (rates >= 0).all() and np.abs(got - [0.7, 0.2, 0.1]).max() < 0.01
    plain = np.ones(500)
    for _ in range(4000):
        residual = (plain * tokens) @ p / tokens.sum() - fit.targets
        plain = np.maximum(0, plain - fit.step * (p @ (residual / fit.shares) + fit.ridge * (plain - 1)))


    def objective(r):
        gap = (r * tokens) @ p / tokens.sum() - fit.targets
        return (gap**2 / fit.shares).sum() / 2 + fit.ridge / 2 * (tokens / tokens.sum() * (r - 1) ** 2).sum()

    assert objective(rates) <= 1.05 * objective(plain) + 1e-6
    still = mixing.fit_rates(df.limit(0), ["a", "b", "c"], {"a": 1.0})
    assert (still.points(p)[0] == 1).all()


def test_mixture_of_documents(documents, spark):
    rng = random.Random(13)
    rows = [(i, _speech(rng, "xx" if i % 4 else "yy", rng.randint(5, 60))) for i in range(200)] + [(900, None), (None, "ka lo"), (901, "")]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, "good" if i % 4 else "bad") for i in range(120)] + [(5, None), (None, "good"), (8888, "bad")], "doc_id long, domain string")
    members, fit = mixing.fit_mixture(docs, labels, ["doc_id", "score"], {"good": 0.95, "bad": 0.05})
    found = mixing.with_copies(members, fit).collect()
    assert len(found) == len(rows)
    assert np.mean([(r["__domain"] == "good") == bool(r["doc_id"] % 4) for r in found if r["doc_id"] is not None and r["doc_id"] < 200]) > 0.97
    mixed = mixing.mixed_rows(docs, labels, {"good": 0.95, "bad": 0.05})
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["__copies"] for r in found)
    assert mixing.mixed_rows(docs, labels.limit(0)).count() == len(rows)
    assert mixing.mixed_rows(docs.limit(0), labels).count() == 0


def test_licences_are_found_and_confirmed(documents):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, f"Some words here.\n{gpl}"), (2, "Released under the MIT License."), (3, "He lost his driving license. The general public was angry."),
        (4, None), (5, ""), (6, "Licensed under CC BY-NC 4.0. And LICENSED UNDER THE APACHE LICENSE, VERSION 2.0."), (7, "x " * 50_000 + "\n" + gpl),
        (None, "Licensed under CC BY-SA 4.0."),
    ]
    docs = documents(rows)
    model = licenses.train_licenses(docs.where("doc_id <> 7"))
    got = {r["doc_id"]: [n["family"] for n in r["__notices"]] for r in licenses.scan_licenses(docs, model, ["doc_id"]).collect()}
    assert got == {1: ["GPL-3.0"], 2: ["MIT"], 3: [], 4: [], 5: [], 6: ["CC-BY-NC-4.0", "Apache-2.0"], 7: ["GPL-3.0"], None: ["CC-BY-SA-4.0"]}
    assert licenses.scan_licenses(documents([]), licenses.train_licenses(documents([])), ["doc_id"]).count() == 0


#: Licences that are none of those listed, each a near relative of one, and notices of listed ones in other words.
RELATIVES = [
    "This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU Affero General Public License, version 3.",
    "Released under the BSD 2-Clause License.", "Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-ND 4.0.", "Released under the ISC License.",
    "Licensed under CC BY-SA 2.5.", "Licensed under the Open Software License, version 3.0.", "Licensed under the GNU Lesser General Public License, version 3.",
    "Licensed under the Academic Free License, version 3.0.", "Released under the BSD 1-Clause License.", "Licensed under CC BY-NC 3.0.",
    "This work is licensed under the GNU General Public License, version 1.", "Licensed under the Apache License.", "Released under the X11 License.",
]
LISTED = {
    "The code is licensed under the Apache License, Version 2.0.": "Apache-2.0", "It was released under the BSD 3-Clause License.": "BSD-3-Clause",
    "This text is licensed under CC BY 4.0.": "CC-BY-4.0", "This text is licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "This book is licensed under the GNU General Public License, version 3.": "GPL-3.0", "All of it is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
}


def test_other_licences_are_not_taken_for_listed_ones(documents):
    rows = [(i, t) for i, t in enumerate([*RELATIVES, *LISTED])]
    rng = random.Random(5)
    corpus = documents([(i, f"{_speech(rng, 'xx', 30)}.") for i in range(60)])
    got = {r["doc_id"]: {n["family"] for n in r["__notices"]} for r in licenses.scan_licenses(documents(rows), licenses.train_licenses(corpus), ["doc_id"]).collect()}
    assert {t: got[i] for i, t in rows if t in RELATIVES and got[i] - {licenses.OTHER}} == {}
    assert sum(bool(got[i]) for i, t in rows if t in RELATIVES) >= 9
    assert {t: got[i] for i, t in rows if t in LISTED} == {t: {f} for t, f in LISTED.items()}


NOTICES = {"All rights reserved.": "Proprietary", "Copyright, all rights reserved.": "Proprietary", "Released under the MIT License.": "MIT",
           "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}


@pytest.mark.parametrize("notice", NOTICES)
def test_a_common_licence_is_still_found(documents, notice):
    rng = random.Random(16)
    odd = ["The software was free for the public.", "All work was done under the terms of the person.", "Rights and copyright of the source, version two."]
    rows = [(i, f"{_speech(rng, 'xx', 30)}.\n{odd[i % 3]} {_speech(rng, 'yy', 9)}." + (f"\n{notice}" if i % 3 == 0 else "")) for i in range(240)]
    docs = documents([*rows, (900, f"ka lo. {notice} mi"), (901, "Released under the MIT License.")])
    got = {r["doc_id"]: [n["family"] for n in r["__notices"]] for r in licenses.scan_licenses(docs, licenses.train_licenses(docs), ["doc_id"]).collect()}
    assert got == {i: [NOTICES[notice]] if i % 3 == 0 else [] for i in range(240)} | {900: [NOTICES[notice]], 901: ["MIT"]}


def test_stages_keep_the_columns_and_clean_documents(documents, spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(14)
    rows = [(i, _speech(rng, lang := ("xx", "yy")[i % 2], 30), lang, f"s{i % 3}") for i in range(60)]
    rows += [(100, rows[3][1].upper(), "yy", "s"), (101, "", None, None), (102, None, None, None), (103, "77 88", "xx", "s")]
    docs = documents(rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [len(corpus_pipeline.STAGES)] == [5]
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns, name
    ids = sorted(r["doc_id"] for r in current.collect())
    assert ids == sorted([*(i for i in range(60) if i != 3), 100])
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in final) == ids and all(r["round_trip"] for r in final)
