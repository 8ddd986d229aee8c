import random
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import leaks, lookalike, repeated_lines, splitting, stuffing
from folioforge.llm.textform import TABLE, canonical, plain_words, word_bytes, words

ODD = "éàÉ́  ​­ﬁＡ．аѕ\rο'-_9\n•œß²"


@given(st.text(alphabet=ODD + "abc .", max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_as_bytes_agree(text):
    decode = lambda b: b.decode("latin-1") if b.decode("latin-1", "replace").isalnum() else b.decode()
    for accents, plain in ((True, words), (False, plain_words)):
        assert len(word_bytes(text, accents)) == len(plain(text))
        if text.isascii():
            assert [decode(b) for b in word_bytes(text, accents)] == plain(text)


def test_canonical_forms():
    assert canonical("Ｂａｓｅ　de​ donn­ées") == "Base de données"
    assert canonical("ﬁn") == "fin" and canonical("аbс") == "abc"
    assert canonical("Base") != canonical("base") and canonical("a b") != canonical("a  b") and canonical("e") != canonical("é")


def brute_pairs(rows):
    form = lambda t: unicodedata.normalize("NFC", t.translate(TABLE))
    rows = {(k, t) for k, t in rows if k and t}
    return {(a, b) for a, t in rows for b, u in rows if a < b and t != u and form(t) == form(u)}


def test_lookalikes(spark):
    base = "La base de données, où l'on écrit : x_1 = 2."
    odd = [base, base.replace(" ", " "), unicodedata.normalize("NFD", base), base.replace("a", "а"), base.upper(), base.replace("é", "e"), base.replace(",", ""), base.replace("1", "１"), "é", "é", "", None, base]
    rows = [(f"k{i}", t, "x") for i, t in enumerate(odd)] + [("k0", base, "y"), (None, base, "z")]
    df = spark.createDataFrame(rows, "id string, body string, form string")  # `form` clashes with an inner name
    got = {tuple(r) for r in lookalike.lookalike_pairs(df, "id", "body").collect()}
    assert got == brute_pairs([(k, t) for k, t, _ in rows]) and len(got) > 5
    forms = {(r.key, r.text): r.form for r in lookalike.unify_text(df, "id", "body").collect()}
    assert forms["k0", odd[0]] == forms["k1", odd[1]] == forms["k2", odd[2]] == forms["k3", odd[3]] != forms["k4", odd[4]]
    assert forms["k11", None] is None and lookalike.unify_text(df, "id", "body").count() == len(rows)
    assert lookalike.lookalike_pairs(df.limit(0), "id", "body").count() == 0


def brute_lines(pages):
    per = {}
    for s, p, t in pages:
        if s is not None and p is not None:
            per.setdefault(s, {})[p] = repeated_lines.line_hashes(t)
    out = set()
    for by in per.values():
        every = [set(x.tolist()) - {0} for x in by.values()]
        for p, x in by.items():
            for i, h in enumerate(x.tolist(), 1):
                n = sum(h in e for e in every)
                if h and n >= 5 and n >= 0.25 * len(by):
                    out.add((p, i))
    return out


def test_repeated_lines(spark):
    rng = random.Random(3)
    pages = []
    for s in ("a", "b", "c"):
        for n in range(rng.choice([6, 30, 60])):
            lines = [f"Mot {s} {rng.random()}".replace("0.", ""), "", rng.choice(["Page 1 / 30", "PAGE  77 / 30", "à part"]), "Ligne légale" if rng.random() < 0.3 else "rien", "texte " + "".join(rng.choices("abcdefgh", k=9))]
            pages.append((s, f"{s}::{n}", "\n".join(lines)))
    pages += [pages[0]] * 40 + [("a", "a::e", ""), ("a", "a::n", None), (None, "x", "rien"), ("b", None, "rien")]
    df = spark.createDataFrame(pages, "source string, page_id string, raw_text string")
    got = {tuple(r) for r in repeated_lines.lines_to_remove(df).collect()}
    assert got == brute_lines(pages) and got
    kept = {r.page_id: r for r in repeated_lines.remove_repeated_lines(df).collect() if r.page_id}
    assert kept["a::n"].kept is None
    assert kept["a::0"].kept.split("\n") == [x for i, x in enumerate(kept["a::0"].text.split("\n"), 1) if ("a::0", i) not in got]
    blocks = repeated_lines.compact_lines(df, "source", "page_id", "raw_text", block_pages=4)
    assert {tuple(r)[:2] for r in repeated_lines.repeated_lines(blocks).collect()} == {tuple(r)[:2] for r in repeated_lines.repeated_lines(repeated_lines.compact_lines(df, "source", "page_id", "raw_text")).collect()}
    assert repeated_lines.lines_to_remove(df.limit(0)).count() == 0


def test_summary_keeps_heavy_lines():
    import numpy as np

    rng = np.random.default_rng(1)
    s = repeated_lines.Summary(0.25)
    pages = [np.concatenate((rng.integers(10, 2**60, 20), [5] if i % 3 == 0 else [6])) for i in range(900)]
    for i in range(0, 900, 100):
        s.add(pages[i : i + 100])
    found = dict(s.candidates())
    assert found[5] >= 300 and found[6] >= 600 and s.error < 0.25 * 900 and len(found) < 50


@given(st.lists(st.sampled_from(["mot", "fin.", "a;", "\n", "\n\n", "SELECT x;\n", "- item\n", " ", "long" * 9]), max_size=600))
@settings(max_examples=60, deadline=None)
def test_pieces(parts):
    text = " ".join(parts)
    tokens = splitting._TOKEN.findall(text)
    found = splitting.pieces_of(text, 70, 8, least=20)
    assert [splitting._TOKEN.findall(text[a:z]) for _, _, a, z in found] == [tokens[f : f + n] for f, n, _, _ in found]
    assert all(n <= 70 for _, n, _, _ in found) and (len(found) > 1) == (len(tokens) > 70)
    for (f, n, _, _), (g, _, _, _) in zip(found, found[1:]):
        assert g == f + n - 8
    if found:
        assert found[0][0] == 0 and found[-1][0] + found[-1][1] == len(tokens)


def test_split_edges_and_locality(spark):
    rng = random.Random(5)
    sentence = lambda: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(12)) + "."
    sentences = [sentence() for _ in range(500)]
    text = " ".join(sentences)
    edited = " ".join([*sentences[:100], "un ajout bref.", *sentences[100:]])
    cut = lambda t: [t[a:z] for _, _, a, z in splitting.pieces_of(t)]
    a, b = cut(text), cut(edited)
    assert len(set(a) & set(b)) >= len(a) - 3 and all(x.rstrip().endswith(".") for x in a)
    df = spark.createDataFrame([("k", text, 1), ("k", text, 2), ("n", None, 3), ("e", "  ", 4), (None, "x", 5), ("s", "court", 6)], "chunk_id string, text string, piece int")
    rows = splitting.split_oversized(df).collect()
    assert {r.chunk_id: r.pieces for r in rows} == {"k": len(a), "n": 1, "e": 1, None: 1, "s": 1} and sum(r.chunk_id == "k" for r in rows) == 2 * len(a)
    assert splitting.split_oversized(df.limit(0)).count() == 0


def test_leaks(spark):
    rng = random.Random(9)
    vocabulary = ["base", "donnée", "table", "index", "clé", "vue", "l'ordre", "coût", "plan", "verrou"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(40), rng.choice([None, "verrou", ""])) for i in range(30)] + [(90, "trop court", "x"), (91, None, None), (3, None, None)]
    items[33:] = []
    docs = [(i, text(rng.choice([3, 60, 200])), "s") for i in range(60)]
    for i in range(60, 90):
        w = items[rng.randrange(30)][1].split()
        at, n = rng.randrange(20), rng.choice([10, 11, 12, 13, 20])
        docs.append((i, text(30) + " zèbre " + " ,\n".join(w[at : at + n]).upper().replace("É", "E") + " zèbre " + text(20), "s"))
    docs += [(100, None, "s"), (101, "", "s"), docs[70]]
    grams = lambda t: {tuple(w[i : i + 12]) for w in [plain_words(t)] for i in range(len(w) - 11)}
    want = {(d, i) for d, t, _ in docs if t for i, x, _ in items if x and grams(t) & grams(x)}
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    it = spark.createDataFrame(items, "item_id int, text string, answer string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked_items(df, it).collect()}
    assert got == want and len(got) > 10
    assert leaks.leaked_items(df, it.limit(0)).count() == 0 and leaks.leaked_items(df.limit(0), it).count() == 0


def test_stuffing(spark):
    rng = random.Random(2)
    noun = lambda: "".join(rng.choices("bcdfglmnprst", k=3)) + rng.choice(["age", "eur", "ion"])
    prose = " ".join(f"Dans la {noun()} du {noun()}, le {noun()} est relu par le {noun()} quand une {noun()} monte et que les {noun()}s changent." for _ in range(12))
    code = "\n".join(f"INSERT INTO t_{i} VALUES ({i}, 'a');" for i in range(30))
    links = "\n".join(f"* http://site{i}.example/cours/page{i}" for i in range(30))
    tags = " ; ".join(f"{rng.choice(['sql', 'pdf', 'cours'])}{i}" for i in range(60))
    stuffed = " ".join(w + " formation sql pas cher" for w in prose.split()[:60])
    docs = [(1, prose), (2, code), (3, links), (4, tags), (5, stuffed), (6, prose + "\nRéférences\n" + links[:300]), (7, None), (8, ""), (9, "  \n"), (1, prose)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, words string")
    rows = stuffing.prose_shares(df).collect()
    share = {r.doc_id: r.other_share for r in rows}
    assert len(rows) == len(docs) and {k for k, s in share.items() if s is not None and s > 0.5} == {3, 4, 5}
    assert share[7] is share[8] is share[9] is None
    assert stuffing.prose_shares(df.limit(0)).count() == 0


def test_hashtags(spark):
    rng = random.Random(4)
    tags = [f"#{rng.choice(['promo', 'corrige', 'clef', 'base', 'cle_usb', 'vue', 'quiz', 'stage'])}{rng.choice(['', '', rng.randrange(99)])}" for _ in range(80)]
    prose = " ".join("Dans la base du serveur, le verrou est pris par la vue quand une session monte et que les lignes changent." for _ in range(3))
    noun = lambda: "".join(rng.choices("bcdfglmnprst", k=3)) + rng.choice(["age", "eur", "ion"])
    comments = "\n".join(f"#le {noun()} est lu dans la {noun()} de C#\nfor {noun()} in {noun()}({i}):" for i in range(20))
    docs = [(1, " ".join(tags)), (2, "\n".join(tags)), (3, "".join(tags)), (4, " ".join(tags).replace("#", "＃")), (5, " ".join(tags).replace("#", "@")), (6, f"{prose}\n{' '.join(tags[:9])}"), (7, f"{prose} {' '.join(tags[:9])}"), (8, comments)]
    share = {r.doc_id: r.other_share for r in stuffing.prose_shares(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert {k for k, s in share.items() if s > 0.5} == {1, 2, 3, 4, 5}, share


def test_line_model_learns_from_all_documents(spark, monkeypatch):
    monkeypatch.setattr(stuffing, "CELLS", 300)
    rng = random.Random(11)
    line = lambda: rng.choice(["Le verrou est pris par la vue quand une session monte.", "* http://site.example/cours", "sql ; pdf ; cours ; quiz", "BEGIN commit; END;", "Accueil", ""])
    docs = [(i, "\n".join(line() for _ in range(rng.choice([1, 3, 40])))) for i in range(450)] + [(900, None), (901, " ")]
    model = stuffing.fit_line_model(spark.createDataFrame(docs, "doc_id bigint, text string"))
    sequences = [q for q in (stuffing.segments(t)[0] for _, t in docs if t) if q]
    assert len(sequences) > stuffing.WORTH
    want = stuffing.LineModel()
    for _ in range(4):
        want = want.learned(want.counts(sequences), len(sequences))
    for a, b in ((model.emission, want.emission), (model.step, want.step), (model.start, want.start)):
        assert abs(a - b).max() < 1e-9
    expected = want.counts([[0, 3, 3]])  # one sequence by all its paths
    paths = {(a, b, c): want.start[a] * want.emission[a, 0] * want.step[a, b] * want.emission[b, 3] * want.step[b, c] * want.emission[c, 3] for a in range(4) for b in range(4) for c in range(4)}
    total, steps = sum(paths.values()), expected[32:48].reshape(4, 4)
    assert abs(steps[1, 2] - sum(p * (x[:2] == (1, 2)) + p * (x[1:] == (1, 2)) for x, p in paths.items()) / total) < 1e-9
    assert abs(expected[:32].reshape(4, 8)[1, 3] - sum(p * ((x[1] == 1) + (x[2] == 1)) for x, p in paths.items()) / total) < 1e-9
