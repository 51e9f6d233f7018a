"""Token output, quality, personal data, language, pieces, urls: brute force, round trips, held-out accuracy."""

import collections
import random
import re
import time
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from relaylens.llm import (
    doc_stats,
    language_id,
    pii,
    quality_classifier,
    quality_rules,
    queries,
    sentencepiece,
    token_output,
    url_filter,
)

from .conftest import prose

tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- token output ----------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 4000])
@pytest.mark.parametrize("top", [1, 2, 200, 50_000, 1 << 32, 1 << 60])
def test_segment_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64)
    ids[rng.integers(0, max(1, n), min(n, 4))] = np.uint64((1 << 64) - 1)
    data = token_output.pack(ids)
    assert np.array_equal(token_output.unpack(data), ids)
    assert np.array_equal(token_output.unpack(data, 1, 2), ids[1024:2048])


def test_segment_rejects_other_bytes():
    with pytest.raises(ValueError):
        token_output.unpack(b"nonsense" * 4)


def test_word_encoder_equals_library():
    from tokenizers import Tokenizer
    path = tokenizers.path(queries.WORD_BPE)
    whole, mine = Tokenizer.from_file(path), token_output.word_encoder(path)
    odd = ["áb ÀÉ ŉ ĳ ſ Œœ ß", "ﬁ Å K İstanbul ǅ", "<|endoftext|>foo bar<|startoftext|>", "don't we'll THE.'s 's", "", " \n",
           "a\u00a0b\u2003c\u0085d\x1c\x1d e\x0bf\x0cg", "ΑΣ ΑΣ. ß", "12,345.67 ab12 x.,", "漢字 かな 🙂", "e\u0301 \u0301a", "...,,, . ,"]
    for text in odd:
        assert np.frombuffer(mine(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_word_encoder_encodes_pieces_once(monkeypatch):
    """Closing signs, digits and endings make no new work for the library: every piece goes to its model once."""
    from tokenizers import Tokenizer
    path, whole, tokenized = tokenizers.path(queries.WORD_BPE), [], []

    class Counted:
        def __init__(self, inner):
            self.inner, model = Tokenizer.from_file(inner), Tokenizer.from_file(inner).model
            self.model = types.SimpleNamespace(tokenize=lambda piece: tokenized.append(piece) or model.tokenize(piece))

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode(self, text, **more):
            whole.append(text)
            return self.inner.encode(text, **more)

    monkeypatch.setattr("tokenizers.Tokenizer", types.SimpleNamespace(from_file=Counted))
    encode = token_output.word_encoder(path)
    text = " ".join(stem + tail for stem in ["Then", "ñandú", "therble", "été"] for tail in ["", ".", "***", "!!", "'s", "7", "-a"])
    expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert np.frombuffer(encode(text), "<u4").tolist() == expected
    assert (whole, len(tokenized)) == ([], len({"then", "ñandú", "therble", "été", ".", "***", "!!", "'s", "7", "-", "a"}))


def test_word_encoder_of_arrays(monkeypatch):
    from tokenizers import Tokenizer
    path, rng = tokenizers.path(queries.WORD_BPE), random.Random(5)
    whole, mine = Tokenizer.from_file(path), token_output.word_encoder(path)
    signs = [*"abXY''sStTreElLdm09.,!|<>#* \t\n\r\x0b\x0c\x1c\x85\xa0ÀßéŒſŉĳİ×÷µªΣς漢🙂", "\u0300", "<|endoftext|>", "'ll"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(3000)] + [None, "", " \n "]
    monkeypatch.setattr(token_output, "GROUP_WORDS", 7)
    monkeypatch.setattr(token_output, "HELD_WORDS", 50)
    for lo in range(0, len(texts), 1000):
        got = mine.many(pa.array(texts).slice(lo, 1000))
        for text, ids in zip(texts[lo:lo + 1000], got, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, text
    assert mine.many(pa.array([], pa.string())) == []


def test_tokens_of_groups(spark, docs, monkeypatch):
    """Groups of texts cut by bytes, and an encoder that only takes single texts, write the same rows."""
    def single():
        encode = queries.word_tokenizer()
        return lambda text: encode(text)

    def written(encoder):
        folder = queries.scratch_folder(spark, "test_groups")
        token_output.write_tokens(docs, folder, encoder)
        return sorted(map(str, token_output.read_tokens(spark, folder).collect()))

    expected = written(queries.word_tokenizer)
    assert written(single) == expected
    monkeypatch.setattr(token_output, "GROUP_BYTES", 1000)
    assert written(queries.word_tokenizer) == expected


def test_token_files(spark, docs, rows, no_docs, monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(token_output, "SEGMENT_IDS", 500)
    folder = queries.scratch_folder(spark, "test_tokens")
    token_output.write_tokens(docs, folder, queries.word_tokenizer)
    got = token_output.read_tokens(spark, folder).collect()
    whole = Tokenizer.from_file(tokenizers.path(queries.WORD_BPE))
    ids = [(r[0], whole.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows]
    assert collections.Counter((r.doc_id, tuple(r.tokens)) for r in got) == collections.Counter((i, tuple(t)) for i, t in ids)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert (r.start, r.n_tokens) == (at, len(r.tokens))
        assert r.crc32 == zlib.crc32(np.array(r.tokens, "<u4").tobytes())
        at += r.n_tokens
    in_order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert in_order == sorted(in_order)
    empty = queries.scratch_folder(spark, "test_no_tokens")
    token_output.write_tokens(no_docs, empty, queries.word_tokenizer)
    assert token_output.read_tokens(spark, empty).collect() == []


# -- quality -----------------------------------------------------------------------

def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    runs = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    cover = {j for k in range(len(w) - 7) if runs[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


def test_base_counts(docs, rows):
    judged = quality_rules.judge(docs, quality_rules.build_references(docs))
    assert judged.columns == [*docs.columns, "quality"]
    got = judged.select("doc_id", "text", "quality.*").collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_counts(r.text)
        assert tuple(r[c] for c in quality_rules.BASE) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_repeated_words_random():
    rng = random.Random(3)
    for _ in range(200):
        text = " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))
        assert doc_stats.repeated_words(text.encode().split()) == brute_counts(text)[4]


def test_references_count_everything(spark):
    rows = [(i, "The cat, the dog." if i % 2 else "der Hund\nder Ball", "en" if i % 2 else "de") for i in range(10)]
    refs = quality_rules.build_references(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert refs["en"][1:] == ({b"the": 10, b"cat": 5, b"dog": 5}, 20)
    assert refs["de"][1:] == ({b"der": 10, b"hund": 5, b"ball": 5}, 20)
    assert refs["en"][0].sum() == 5 * len("The cat, the dog.")


def test_divergence(spark, no_docs):
    p, q = np.array([1.0, 0]), np.array([0, 2.0])
    assert quality_rules.js_distance(p, p * 3) == 0 and quality_rules.js_distance(p, q) == 1
    rng = random.Random(4)
    clean = [(i, prose(rng, 150), "en") for i in range(40)]
    junk = [(100, "|".join(prose(rng, 1).upper() + "!!" + " #" * 2 for _ in range(150)), "en"),
            (101, " ".join(f"zq{rng.random()}" for _ in range(150)), "en")]
    docs = spark.createDataFrame(clean + junk, "doc_id int, text string, lang string")
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs, quality_rules.build_references(docs)).select("doc_id", "quality.*").collect()}
    assert all(got[i] for i in range(40)) and not got[100] and not got[101]
    assert quality_rules.build_references(no_docs) == {}
    assert quality_rules.judge(no_docs, {}).collect() == []
    kept = quality_rules.judge(docs, {}).select("quality.*").first()
    assert kept.kept and kept.nearest is None


def test_rare_languages_are_judged_by_their_own(spark):
    """One document in 1500 has a language and script of its own; junk beside it and languages
    of hardly any text excuse nothing."""
    rng = random.Random(6)
    greek = "ποταμός σπίτι κήπος παράθυρο ασήμι πρωί άνθρωποι και στο από με το".split()
    rows = [(i, prose(rng, 80), "en") for i in range(1500)] + [(2000, prose(rng, 200, greek), "el")]
    rows += [(2001, " ".join(f"zq{rng.random()}" for _ in range(150)), "en"), (2002, None, "aa"), (2003, "oh no", "ab"),
             (2004, " ".join(["unusual" * 2] * 40), "ac"), (2005, " ".join("字" + chr(0x4E00 + i) for i in range(1100)), "zh")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    refs = quality_rules.build_references(docs)
    assert refs["el"][2] == 200 and refs["ab"][2] == 2 and refs["zh"][1:] == ({}, 1100)
    got = {r.doc_id: r for r in quality_rules.judge(docs, refs).select("doc_id", "quality.*").collect()}
    assert got[2000].kept and got[2000].nearest == "el" and got[2000].class_distance < 1e-6
    assert got[2005].kept and got[2005].nearest == "zh"     # no word of it is common
    assert all(got[i].kept and got[i].nearest == "en" for i in range(1500)) and not got[2001].kept


def test_trees_learn_and_walk():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] > 0.7)).astype(float)
    model = quality_classifier.fit_trees(x[:2000], y[:2000], trees=40)
    assert ((model.score(x[2000:]) >= 0.5) == (y[2000:] == 1)).mean() > 0.97
    inner = model.feature.shape[1]
    for row in x[:20]:                                    # one row at a time, node by node
        margin = model.base
        for t in range(len(model.feature)):
            node = 0
            while node < inner:
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.threshold[t, node])
            margin += model.leaf[t, node - inner]
        assert model.margin(row[None])[0] == pytest.approx(margin)


def test_quality_classifier(spark, docs, rows, no_docs):
    marks = [(r[0], i % 2, None) for i, r in enumerate(rows)] + [(0, None, 1), (None, 1, 1), (0, 1, 1), (5000, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    model = quality_classifier.fit_quality(docs, labels)
    scored = quality_classifier.score_quality(docs.drop("score"), model)
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    untaught = quality_classifier.fit_quality(docs, labels.filter("false"))
    assert {r.score for r in quality_classifier.score_quality(docs, untaught).select("score").collect()} == {0.5}
    assert quality_classifier.score_quality(no_docs, model).collect() == []


def test_quality_held_out(spark):
    got = queries.op10_quality_classifier(spark, "/root/testdata/sf0.01").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    right = got.join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.9


# -- personal data -------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_patterns_equal_plain_search():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b@", "@", ".", "1", "25", "255", "256", "0", " ", "-", "+", "(", "_", "é", "4111 1111 1111 1111"])
                       for _ in range(rng.randint(0, 25)))
        assert pii.pattern_spans(text) == brute_pii(text), text


def test_tagger_gradients():
    model, rng = pii.Tagger.new(3), np.random.default_rng(0)
    codes, tags = rng.integers(1, pii.VOCABULARY, (6, 3)), rng.integers(0, pii.TAGS, (6, 3))
    _, grad = pii.gradients(model, codes, tags)
    for name in "uvebts":
        value = getattr(model, name)
        at = (0, 2, int(codes[1, 1])) if name == "u" else tuple(rng.integers(0, n) for n in value.shape)
        old = value[at]
        loss = []
        for move in (1e-5, -1e-5):
            value[at] = old + move
            loss.append(pii.gradients(model, codes, tags)[0])
        value[at] = old
        assert (loss[0] - loss[1]) / 2e-5 == pytest.approx(grad[name][at], abs=1e-4)


def test_decode_is_the_best_path():
    model, rng = pii.Tagger.new(3, seed=4), np.random.default_rng(1)
    lengths = np.array([2, 4, 5])
    codes = rng.integers(1, pii.VOCABULARY, (5, 3)).astype(np.uint8)
    for col, n in enumerate(lengths):
        codes[n:, col] = 0
    em, (tags, _) = model.emissions(codes), model.decode(codes, lengths)
    for col, n in enumerate(lengths.tolist()):
        def score(path, col=col):
            return model.s[path[0]] + sum(em[t, k, col] for t, k in enumerate(path)) + sum(
                model.t[a, b] for a, b in zip(path, path[1:], strict=False))
        paths = np.stack(np.meshgrid(*[range(pii.TAGS)] * n)).reshape(n, -1).T.tolist()
        assert score(tags[:n, col].tolist()) == pytest.approx(max(map(score, paths)))


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.fit_tagger(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def _grouped(span, sign):
    digits = pii._digits(span)
    return sign.join(digits[k:k + 4] for k in range(0, len(digits), 4))


def _phone(span, form):
    d = pii._digits(span)[-10:]
    return form.format(a=d[:3], b=d[3:6], c=d[6:])


#: Forms that the tagger is not trained on, by kind.
UNSEEN = {
    "email": [lambda s, at=at, dot=dot: s.replace(".", dot).replace("@", at)
              for at in (" {at} ", "{at}", "(AT)", "_at_") for dot in ("{dot}", " (dot) ", "{.}", "_dot_", ".")],
    "ip": [lambda s, x=x: s.replace(".", x) for x in ("{.}", "[dot]", ". ", " [.] ")],
    "card": [lambda s, x=x: _grouped(s, x) for x in (" - ", " -", "|", " _ ")],
    "phone": [lambda s, f=f: _phone(s, f) for f in ("{a}_{b}_{c}", "({a}) {b} {c}", "({a})-{b}-{c}", "{a} {b}-{c}", "0044-{a}-{b}-{c}")],
}


def test_unseen_forms_are_no_training_forms():
    assert not {" {at} ", "{at}", "(AT)", "_at_"} & set(pii.AT_FORMS)
    assert not {"{dot}", " (dot) ", "{.}", "_dot_"} & set(pii.DOT_FORMS)
    assert not {"{.}", "[dot]", ". ", " [.] "} & set(pii.IP_FORMS)
    assert not {" - ", " -", "|", " _ "} & set(pii.CARD_FORMS) and not set("|_{}") & set(pii.ODD_SIGNS) and "_" not in pii.PHONE_SIGNS


@pytest.mark.parametrize("kind", pii.KINDS)
def test_tagger_finds_unseen_forms(spark, tagger, kind):
    """At least nine in ten made-up data of each kind, in forms that neither patterns nor training have."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    plain = [t for t in texts if not pii.pattern_spans(t)]
    rng, made = random.Random(3), np.random.default_rng(17)
    tried = []
    for k in range(200):
        text, word = rng.choice(plain), UNSEEN[kind][k % len(UNSEEN[kind])](pii.invented(kind, made))
        at = rng.randrange(len(text) + 1)
        lead = text[max(0, at - 700):at] + " "
        tried.append((lead + word + " " + text[at:at + 100], len(lead), len(lead) + len(word)))
    spans = pii.all_spans(tagger, [t for t, _, _ in tried])[1]
    hits = sum(any(x[0] == kind and x[1] < b and x[2] > a for x in s) for s, (_, a, b) in zip(spans, tried, strict=True))
    assert hits >= 0.9 * len(tried)


def test_tagger_leaves_clean_documents(spark, tagger):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    plain = [t for t in texts if not pii.pattern_spans(t)]
    extra = sum(len(s) for at in range(0, len(plain), 200) for s in pii.all_spans(tagger, plain[at:at + 200])[1])
    assert extra <= 0.01 * len(plain)


@pytest.mark.parametrize("lead", [0, 300, 430, 448, 470, 505, 600, 890])
def test_long_spans_are_whole(tagger, lead):
    """A datum longer than the overlap of windows, wherever their edges cut it."""
    word = "first.middle.last at " + " dot ".join(["mail", "department", "faculty", "university", "campus", "example", "org"])
    text = ("plain words " * 100)[:lead] + " " + word + " " + "more words " * 80
    found = pii.all_spans(tagger, [text])[1][0]
    assert len(word) > pii.OVERLAP and [s[0] for s in found] == ["email"]
    assert found[0][2] - found[0][1] >= 0.9 * len(word)


def test_windows_without_plausible_spans():
    """Whatever is plausible lies in a window that is decoded."""
    rng = random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choice(["a", "at", "@", ".", " . ", " at ", " dot ", "[.]", "(", ")", "1", "25", " ", "-", "x.y"]) for _ in range(rng.randint(0, 25)))
        if any(pii.plausible(k, text) for k in pii.KINDS):
            assert pii.may_hold(f"some {text} more")


def test_spans_do_not_depend_on_neighbours(tagger):
    rng = random.Random(8)
    texts = [prose(rng, rng.randint(0, 400)) + " call 555-123-4567 or 10[.]2[.]3[.]4 " + prose(rng, rng.randint(0, 300)) for _ in range(20)]
    together = pii.tagger_spans(tagger, texts)
    strip = lambda found: [s[:3] for s in found]
    assert [strip(f) for f in together] == [strip(pii.tagger_spans(tagger, [t])[0]) for t in texts]
    for found in together:
        assert all(a[2] <= b[1] for a, b in zip(found, found[1:], strict=False))


def test_find_and_redact(spark, docs, rows, no_docs, tagger):
    found = pii.find_pii(docs, tagger).select("text", "pii.*").collect()
    assert len(found) == len(rows)
    text = "x a.b@c.de, 1.2.3.4, 4111 1111 1111 1111, +1 (222) 333-4444 é"
    one = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    for model in (None, tagger):
        r, null, empty = pii.find_pii(one, model).orderBy("doc_id").select("pii.*").collect()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
        assert r.base == "email:2:10,ip:12:19,card:21:40,phone:42:59"
        assert set(r.base.split(",")) <= set(r.spans.split(","))
        assert (null.spans, empty.spans) == ("", "")
        clean = one.orderBy("doc_id").select(pii.redacted(F.col("text"), model).alias("t")).collect()
        assert [c.t for c in clean] == ["x <EMAIL>, <IP>, <CARD>, <PHONE> é", None, ""]
    assert pii.fit_tagger(no_docs) is None
    assert pii.find_pii(no_docs, None).collect() == []


# -- language ----------------------------------------------------------------------------

def test_language_held_out(spark):
    got = queries.op6_language_id(spark, "/root/testdata/sf0.01").filter("held_out")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_language_edges(spark, docs, rows, no_docs):
    model = language_id.fit_languages(docs)
    got = language_id.predict_language(docs, model).select("text", "language.*").collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang == "und") == (not letters) and 0 <= r.score <= 1 and (letters or r.score == 0)
    nothing = language_id.fit_languages(no_docs)
    assert {r.lang for r in language_id.predict_language(docs, nothing).select("language.*").collect()} == {"und"}
    single = language_id.fit_languages(docs.filter("lang = 'de'"))
    assert {(r.lang, r.score) for r in language_id.predict_language(docs.filter("doc_id < 20"), single)
            .select("language.*").collect()} == {("de", 1.0)}


def test_vectors_of_long_texts():
    text = "äbc defg " * 20_000
    assert len(text.encode()) > language_id.PIECE // 2
    old, language_id.PIECE = language_id.PIECE, 1000
    try:
        small = language_id.vector_of(text)
    finally:
        language_id.PIECE = old
    assert np.allclose(small, language_id.vector_of(text)) and np.sum(small[:-1] ** 2) == pytest.approx(1, abs=1e-4)


# -- pieces ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def automaton():
    return sentencepiece.load_model(tokenizers.path(queries.PIECES))


def test_best_path_equals_plain_search():
    rng = random.Random(9)
    for trial in range(30):
        pieces = sorted({"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4))) for _ in range(12)})
        scored = [(i, p, float(-rng.randint(1, 9))) for i, p in enumerate(pieces)]
        auto = sentencepiece.Automaton.build(scored, [p.encode() for p in pieces], None, 99)
        value = {p: s for _, p, s in scored}
        for _ in range(20):
            chunk = "".join(rng.choice("abcd▁") for _ in range(rng.randint(1, 12)))
            best = [0.0] + [-np.inf] * len(chunk)
            for t in range(1, len(chunk) + 1):
                for s in range(t):
                    step = value.get(chunk[s:t], auto.unknown if t - s == 1 else None)
                    if step is not None:
                        best[t] = max(best[t], best[s] + step)
            side, alone = auto.solve([chunk, "a"])[0], auto.solve_long(chunk)
            assert side == alone
            side = np.frombuffer(side, "<i4").tolist()
            assert sum(value[pieces[i]] if i != 99 else auto.unknown for i in side) == pytest.approx(best[-1])


def test_best_path_equals_library_lattice(spark, automaton):
    """The library's n-best lattice on the same file, its model type set from merges to unigram."""
    from sentencepiece import SentencePieceProcessor
    data = open(tokenizers.path(queries.PIECES), "rb").read()
    at = data.rfind(bytes([0x18, 2, 0x20]))
    library = SentencePieceProcessor()
    library.LoadFromSerializedProto(data[:at] + bytes([0x18, 1]) + data[at + 2:])
    words = {w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() for w in (r.text or "").split()}
    words = sorted(words)[:4000]
    for word, ids in zip(words, automaton.encoder()(words).to_pylist(), strict=True):
        assert library.nbest_encode_as_ids(word, 2)[0] == ids, word


@pytest.mark.parametrize("text", ["", " ", "\n", "  a  b\n\nc\t d ", "漢字🙂 \x00 ok", "é" * 70 + "🙂" * 50, "x" * 50_000, "the river " * 999])
def test_pieces_round_trip(automaton, text):
    ids = automaton.encoder()([text]).to_pylist()[0]
    assert automaton.decode(ids) == text


def test_pieces_of_documents(spark, docs, rows, no_docs):
    model = queries.piece_model(spark)
    got = queries.encoded(docs, model).collect()
    assert collections.Counter((r.doc_id, r.decoded) for r in got) == collections.Counter(r[:2] for r in rows)
    assert all(r.round_trip and (r.pieces is None) == (r.text is None) for r in got)
    assert queries.encoded(no_docs, model).collect() == []
    apart = sentencepiece.decode(sentencepiece.encode(docs, model), model).select("doc_id", "pieces", "decoded").collect()
    assert sorted(map(str, apart)) == sorted(str(r) for r in queries.encoded(docs, model).select("doc_id", "pieces", "decoded").collect())


# -- urls -------------------------------------------------------------------------------

def brute_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for action, rule in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), action == "block", rule))
    best = max(fits, default=None)
    return host, path, best and best[2], "block" if best and best[1] else "allow"


def test_urls(spark):
    rules = [("block", "net/"), ("allow", "a.net/en/"), ("block", "a.net/en/x"), ("allow", "org/f"), ("block", "org/f"),
             ("block", "b.org/"), ("allow", "b.org/de/y/z")]
    rng = random.Random(10)
    urls = [None, "", "nothing", "://", "http://", "http://A.NET", "x://org/f?q://net/", "http://net/#a/b"]
    urls += ["".join([rng.choice(["http://", "ftp://"]), rng.choice(["a.net", "xa.net", "q.A.net", "net", "c.b.org", "b.org", "org", "anet"]),
                      rng.choice(["", "/", "/en", "/en/", "/en/xy/", "/f", "/foo/", "/de/y/z1", "/de/y/"]), rng.choice(["", "?a=/x", "#t"])])
             for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id int, url string, host string, rule string")
    got = url_filter.judge_urls(pages, rules).select("url", "judged.*").collect()
    for r in got:
        assert (r[1], r[2], r[3], r[4]) == brute_judge(r.url, rules), r.url
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, [("maybe", "net/")])
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []


def best_rule(host, path, rules):
    """(rule, action) by the rank of every fitting rule: length, block, longer host."""
    fits = []
    for action, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(slash + p):
            fits.append((len(rule), action == "block", len(h), rule, action))
    return max(fits)[3:] if fits else None


def test_equally_long_rules_and_many_last_segments():
    rng = random.Random(5)
    hosts, paths = ["a.b.c", "b.c", "c", "xb.c", "b.a.b.c"], ["", "/", "/p", "/pq", "/p/q", "/p/qq", "/ppppp", "/p/q/r"]
    for _ in range(300):
        rules = list({r: (rng.choice(["allow", "block"]), r) for r in
                      (rng.choice(hosts) + rng.choice(paths) for _ in range(rng.randint(0, 12)))}.values())
        trie = url_filter.UrlTrie(rules)
        for h in hosts:
            for p in paths:
                assert trie.match(h, p) == best_rule(h, p, rules), (h, p, rules)
    tie = [("allow", "c/pppp"), ("block", "b.c/pp"), ("allow", "a.b.c/")]
    assert url_filter.UrlTrie(tie).match("a.b.c", "/ppppp") == ("b.c/pp", "block")
    assert url_filter.UrlTrie([(("allow"), r) for _, r in tie]).match("a.b.c", "/ppppp") == ("a.b.c/", "allow")
    many = url_filter.UrlTrie([("block", f"one.net/{i:06}") for i in range(100_000)])
    start = time.perf_counter()
    assert [many.match("one.net", f"/{i:06}x")[0] for i in range(2000)] == [f"one.net/{i:06}" for i in range(2000)]
    assert time.perf_counter() - start < 1                  # 5 ms a url when all were scanned


def test_urls_keep_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "Judged int, url string")
    with pytest.raises(ValueError, match="already"):
        url_filter.judge_urls(pages, [("block", "net/")])
    assert url_filter.judge_urls(pages, [("block", "net/")], out="found").first()["Judged"] == 1
