"""Each operator against a plain version, and on nulls, empty and long texts, repeated rows, empty
tables and clashing names."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import time
import tracemalloc
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlume.llm import neardup, tokens
from postlume.llm.bytepairs import BytePairCounter
from postlume.llm.decontaminate import contamination, decontaminate
from postlume.llm.eliasfano import EliasFano
from postlume.llm.graph import components
from postlume.llm.html import extract_main_text, main_text
from postlume.llm.language import STRETCH, CrossParser, held_out, identify, learn, suffix_automaton
from postlume.llm.licenses import KNOWN, license_scan
from postlume.llm.neardup import _word_lists, edits_within, near_dedup, similar
from postlume.llm.pieces import PieceModel
from postlume.llm.pretokens import pretokens, strings
from postlume.llm.quality import quality_rules
from postlume.llm.queries import QUERIES
from postlume.llm.spans import sequence_hash, span_hash, utf8
from postlume.llm.substring import substring_dedup
from postlume.llm.tokens import count_tokens, encode_pieces, read_ids, write_ids
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_words string, kept string, class_id string, score string, n_tokens string, extra int"
LONG = " ".join(f"w{i}" for i in range(30_000)) + "."
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (4, LONG), (None, "a b"), (5, "The cat sat on the mat."), (6, "the cat sat, on the mat"),
       (6, "other text of a repeated id"), (7, "x" * 50_000), (8, "!!! ???")]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(*r, "n", "k", "c", "s", "t", 1) for r in ODD], SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def noise(alphabet: list[str], n: int = 400, longest: int = 60, seed: int = 7) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(rng.choice(alphabet)) for _ in range(rng.randrange(longest))) for _ in range(n)]


TEXTS = ["", " ", "  x", "a \n b\n\n", "don't we're they'll I'd", "'rex 'r 's''s", "<|endoftext|> a<|endoftext|>", "▁▁ a", "日本語 😀", "tt" * 90, " " * 40 + "x",
         *noise(["ab' st", "'srvtlemd ", "the nd in ", "éèç aeiou", "0123456789.,", "\t\n =+-*/(){}", "日本語 abc😀", "   x\n"])]


def test_main_text():
    page = ("<html><body class='has-sidebar'><header>Site name</header><nav><a href=x>Home</a></nav><div class=ad>Buy the best of all</div>"
            "<article><div class='article-header'><h1>Title &amp; more</h1></div><p>First&nbsp; para <b>bold</b><script>x<y</script>\n text"
            "<p>second <a href=x>linked words</a><form>Name <input></form><div class=comments>I like it</div></article>"
            "<aside>Side</aside><footer>&copy; x</footer>")
    assert main_text(page) == "Title & more First para bold text second linked words"
    good = "The house of the day is in the town and it was all for the best of them, which is to say long."
    assert main_text(f"<p>intro</p><p>{good}</p><h2>Head</h2><p>{good}</p><li><a>link</a></li><p>end</p>") == f"intro {good} Head {good}"
    assert [main_text(x) for x in ("", "<", "<p", "<!--", "<script>", "only this", "a < b")] == ["", "<", "", "", "", "only this", "a < b"]


def test_main_text_table(spark):
    rows = [(1, "u", None, 5), (1, "u", None, 5), (2, None, "<article>" + "<p>ab" * 20_000, 6)]
    frame = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int"))
    assert frame.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, r.n_chars) for r in frame.collect()) == [(1, 0), (1, 0), (2, 59_999)]
    assert extract_main_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


@pytest.mark.parametrize("lanes", [1, 7, 4096])
def test_pretokens(lanes):
    split = Tokenizer.from_file(BYTES).pre_tokenizer
    points, starts, sizes, text = pretokens(TEXTS, lanes)
    got = [[] for _ in TEXTS]
    for piece, i in zip(strings(points, starts, sizes), text):
        got[i].append(piece)
    assert got == [[t[a:b] for _, (a, b) in split.pre_tokenize_str(t)] for t in TEXTS]


def test_transducer_counts():
    with open(BYTES, "rb") as file:
        counter = BytePairCounter(file.read())
    library = Tokenizer.from_file(BYTES)
    want = [len(e.ids) for e in library.encode_batch(TEXTS, add_special_tokens=False)]
    assert counter.count(TEXTS).tolist() == want
    counter.kept = 1 << 30  # full: compiled anew, in the middle of a batch too
    assert counter.count(TEXTS).tolist() == want


def test_count_tokens(spark, odd, empty):
    got = {(r.doc_id, r.n_bytes): (r.n_tokens, r.over_limit, r.extra) for r in count_tokens(odd, BYTES).collect()}
    library = Tokenizer.from_file(BYTES)
    for id, text in ODD:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert got[id, len((text or "").encode())] == (n, n > 1024, 1)
    assert count_tokens(empty, BYTES).count() == 0


@pytest.mark.parametrize("values", [[0], [0, 5], [0, 0, 0, 7, 7, 1000, 10**9], list(range(0, 90_000, 17)), [3] * 700])
def test_elias_fano(values):
    code = EliasFano.from_bytes(EliasFano.of(np.array(values)).to_bytes())
    assert code.all().tolist() == values
    assert [code.select(i) for i in range(len(values))] == values
    assert len(code.to_bytes()) <= 17 + 2 + len(values) * (2 + max(1, values[-1] // len(values)).bit_length()) / 8


def test_ids_in_files(spark, odd, empty, tmp_path):
    library = Tokenizer.from_file(BYTES)
    for frame in (documents(spark), odd):
        folder = str(tmp_path / f"ids{len(frame.columns)}")
        write_ids(frame, BYTES, folder)
        got = [tuple(r) for r in read_ids(spark, folder).orderBy("start").collect()]
        rows = sorted(((r.doc_id, r.text or "") for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        assert [r[0] for r in got] == [r[0] for r in rows]
        start = 0
        for doc, at, n, _ in got:
            assert at == start
            start += n
        want = sorted((str(id), len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes()))
                      for id, ids in ((id, library.encode(t, add_special_tokens=False).ids) for id, t in rows))
        assert sorted((str(r[0]), r[2], r[3]) for r in got) == want
    write_ids(empty, BYTES, str(tmp_path / "none"))
    assert read_ids(spark, str(tmp_path / "none")).count() == 0


def test_ids_take_little_memory():
    """What an encoder holds at once, beside the words that it remembers, stays small whatever comes in a batch."""
    with open(BYTES, "rb") as file:
        encoder = tokens._WordEncoder(file.read())
    batch = pa.record_batch([pa.array(["some words of a text " * 100] * 4000)], ["text"])
    tracemalloc.start()
    n = sum(encoder.encode(texts, 2)[1].sum() for _, _, texts in tokens._texts(batch, "text", tokens.STORED_PIECE))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 4000 * 500 and peak < 200 << 20


def test_pieces():
    with open(PIECES, "rb") as file:
        proto = file.read()
    model, library = PieceModel(proto), sentencepiece.SentencePieceProcessor(model_proto=proto)
    texts = [*TEXTS, "ab" * 300, "aaaa" * 200, " " * 200, "<0x41></s>", "\x00a"]
    ids, counts = model.encode(texts)
    edge = np.concatenate([[0], np.cumsum(counts)])
    got = [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])]
    want = [library.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert got == want
    assert [d.decode() for d in model.decode(ids, counts)] == [library.decode(w) for w in want]


def test_encode_pieces(spark, odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = encode_pieces(odd, PIECES, with_ids=True, with_text=True).collect()
    assert len(rows) == len(ODD)
    want = collections.Counter((id, hashlib.sha256(np.array(library.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes()).hexdigest()) for id, t in ODD)
    assert collections.Counter((r.doc_id, r.ids_sha256) for r in rows) == want
    assert all(brute.sha(r.decoded_text) == r.decoded_sha256 and len(r.ids) == r.n_tokens for r in rows)
    assert encode_pieces(empty, PIECES).count() == 0


def test_language(spark, odd, empty):
    docs = documents(spark)
    assert {r.h for r in docs.select((held_out("doc_id") == (F.crc32(F.col("doc_id").cast("string")) % 5 == 0)).alias("h")).collect()} == {True}
    parser = learn(docs)
    rows = identify(docs.withColumn("held", held_out("doc_id")), parser).where("held").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    got = [(r.text, r.lang_pred, r.score) for r in identify(odd, parser).collect()]
    assert all((p, s) == ("und", 0.0) for t, p, s in got if not t or not any(c.isalpha() for c in t))
    none = learn(empty.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in identify(odd, none).collect()} == {"und"}
    assert identify(empty, parser).count() == 0


def brute_phrases(sample: bytes, text: bytes) -> int:
    """Greedy phrases of a text, anew in each stretch, by looking into the sample itself."""
    n = 0
    for at in range(0, len(text), STRETCH):
        n, current = n + 1, b""
        for c in text[at:at + STRETCH]:
            c = bytes([c])
            if current + c in sample:
                current += c
            else:
                n, current = n + 1, c if c in sample else b""
    return n


def letters_of(text: str) -> str:
    return re.sub("\0+", "\0", "".join(c if unicodedata.category(c)[0] in "LM" else "\0" for c in text.lower()))


def test_cross_entropy_equals_the_plain_version():
    samples = {"a": ["der Hund und die Katze, größer als 3", "das Haus"], "b": ["the dog and the cat", "한국어 문장"], "c": ["собака и кошка"]}
    parser = CrossParser(samples, 90)
    texts = noise(["der und die katze ", "the dog ", "собака ", "한국어 문장 ", "12!? ", "größe 漢字"], n=60) + ["", "x" * 5000, "das haus " * 700]
    bits, letters = parser.entropy(texts)
    for name, column in zip(parser.languages, bits.T):
        sample = ("\0" + "".join(letters_of(t) + "\0" for t in samples[name])).encode()[:30]
        for text, found, n in zip(texts, column, letters):
            plain = letters_of(text)
            assert n == len(plain.replace("\0", ""))
            expected = brute_phrases(sample, plain.encode()) * np.log2(len(sample)) / max(1, len(plain))
            assert abs(found - expected) < 1e-9


def test_languages_with_large_alphabets(spark):
    """Some thousand letters each; Chinese and Japanese share many."""
    rng = random.Random(5)
    syllables = [chr(rng.randrange(0xAC00, 0xD7A3)) for _ in range(900)]
    signs = [chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(1500)]
    kana = [chr(c) for c in range(0x3042, 0x3090)]
    words = {"ko": ["".join(rng.choice(syllables) for _ in range(3)) for _ in range(400)],
             "zh": ["".join(rng.choice(signs) for _ in range(2)) for _ in range(400)],
             "ja": [rng.choice(signs) + "".join(rng.choice(kana) for _ in range(3)) for _ in range(400)],
             "en": ["".join(rng.choice("etaoinshrdlu") for _ in range(5)) for _ in range(400)]}
    rows = [(i, (" " if lang in ("ko", "en") else "").join(rng.choice(words[lang]) for _ in range(40)), lang)
            for i, lang in enumerate(list(words) * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify(docs.withColumn("held", held_out("doc_id")), learn(docs)).where("held").select("lang", "lang_pred").collect()
    assert len(got) > 40 and all(r.lang == r.lang_pred for r in got)


def test_longest_matches():
    text = [random.Random(1).randrange(3) for _ in range(60)]
    go = suffix_automaton(text)
    inside = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for word in inside | {(0, 1, 2) * 3, (2, 2, 2, 2, 2, 2)}:
        state = 0
        for c in word:
            state = go[state].get(c) if state is not None else None
        assert (state is not None) == (word in inside)


@pytest.mark.parametrize("cells", [4, 27])
def test_substring(spark, cells):
    """A sketch that is full loses nothing either."""
    docs = documents(spark)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(docs, log2_cells=max(cells, 16)).collect()}
    assert got == brute.substring([(r.doc_id, r.text) for r in docs.collect()])


def test_substring_odd(spark, odd, empty):
    words = " ".join(f"v{i}" for i in range(25))
    rows = [(2, words), (1, "x " + words), (3, "a " * 30), (None, words), (4, None)]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {None: (25, 0), 1: (26, 25), 2: (25, 25), 3: (30, 29), 4: (0, 0)}
    found = substring_dedup(odd).collect()
    assert len(found) == len(ODD) and all(r.n_removed == 0 for r in found)  # equal rows of one id are one document
    assert [r.kept_text for r in found if r.doc_id == 3] == [" \n\t "]
    assert substring_dedup(empty).count() == 0


def test_licenses(spark, odd, empty):
    isc = dict(KNOWN)["ISC"]
    rows = [(1, "Some text.\nreleased under the M.I.T. licence\nReleased under the MIT Licence!\nReleased under the MIT License."),
            (2, "Copyright (c) 2020, A. N. Other\n\n" + isc.upper().replace("\n", "  \n ")), (3, "This mentions the MIT License only."),
            (4, "This work is licensed under the GNU GPL v3.0"), (None, "Licensed under CC-BY-NC 4.0"), (4, "All rights reserved"), (5, None)]
    got = {(r.id, r.license_id, r.whole, r.n_lines) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT", False, 1), (2, "ISC", True, 0), (4, "GPL-3.0", True, 1), (4, "LicenseRef-all-rights-reserved", True, 1),
                   (None, "CC-BY-NC-4.0", True, 1)}
    assert license_scan(odd).count() == 0 and license_scan(empty).count() == 0


def test_quality(spark, odd, empty):
    def lines(n):
        return [" ".join(f"word{i}x{j}" for j in range(11)) + "." for i in range(n)]

    bad = "home | news | about | the | firm | contact"
    rows = [(1, "\n".join(lines(5))), (2, "\n".join(lines(4) + [f"{bad} {i}" for i in range(6)])),
            (3, "\n".join(lines(9) + [bad])), (4, "again " * 40)]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, False, True, False]
    assert got[3].clean_text == rows[2][1].rsplit("\n", 1)[0] and got[4].base_failed and got[4].n_repeat_words == 40
    kept = quality_rules(odd)
    assert kept.count() == len(ODD) and kept.where("kept").select("doc_id").distinct().count() == 1
    assert kept.where("text is null").first().n_words == 0
    assert quality_rules(empty).count() == 0


def test_quality_verdicts_by_hand(spark):
    """What is expected, stated without the patterns."""
    def line(n, words="the town council met on monday and decided to build a bridge over that river"):
        return " ".join(f"{w}{chr(97 + n)}" for w in words.split())

    def four(words, end):
        return "\n".join(line(n, words) + end for n in range(4))

    rows = {
        1: (f"{line(0)}.\n{line(1)}.", True), 2: (" ".join(f"word{i}" for i in range(2000)) + " about cookies and more.", True),
        3: (f"{line(0)}.\nWe use cookies.\nAll rights reserved.\n{line(1)}.", True),
        4: (four("नगर परिषद ने सोमवार को बैठक की और नया पुल बनाने का निर्णय लिया", "।"), True),
        5: (f"{line(0)}.\t\n{line(1)}!\r\n{line(2)}?  ", True), 6: ("\n".join(f"Home{i} | News{i} | Contact{i} | About{i}." for i in range(9)), False),
        7: (f"{line(0)}\n{line(1)}\n{line(2)}", False), 8: (four("اجتمع مجلس المدينة يوم الاثنين وقرر بناء جسر جديد", "؟"), True),
        9: ("\n".join(f"Click here and subscribe now x{i}." for i in range(9)), False)}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in rows.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert {i: got[i].kept for i in rows} == {i: kept for i, (_, kept) in rows.items()}
    assert got[3].clean_text == f"{line(0)}.\n{line(1)}." and got[2].n_removed_words == 0


def test_whole_licences_in_their_usual_wrapping(spark):
    from postlume.llm import licenses as L
    isc = [t for n, t in L.KNOWN if n == "ISC"][0].split()
    wrapped = "\n".join(" ".join(isc[i:i + 12]) for i in range(0, len(isc), 12)).replace("above copyright", "above\ncopyright")
    texts = {1: ("MIT License\n\nCopyright (c) 2020 Ann Example\n\n" + L.MIT, "MIT"), 2: (L.MIT.upper().replace("\n", "\r\n"), "MIT"),
             3: (f"Copyright 2019, The Authors\n© 2021 others\n{wrapped}\n", "ISC"),
             4: ("Copyright (c) 2001-2022, X\n" + L.BSD_OPENING + L.BSD_THIRD + L.BSD_CLOSING, "BSD-3-Clause"),
             5: ("BSD 2-Clause License\n\n(c) 2020 Y\n" + L.BSD_OPENING + L.BSD_CLOSING, "BSD-2-Clause"),
             6: ("# " + L.APACHE_NOTICE.replace("\n", "\n# "), "Apache-2.0"), 7: (L.GPL_NOTICE, "GPL-3.0-or-later"),
             8: (L.MIT.replace("free of charge", "for a fee"), None), 9: ("We discuss the MIT License here.\n" + L.MIT, None)}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    got = {r.id: r.license_id for r in license_scan(docs).where("whole").collect()}
    assert got == {i: name for i, (_, name) in texts.items() if name}


def test_quality_is_native(spark):
    plan = quality_rules(documents(spark)).where("kept")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


ARTICLE = ("<h1>Title</h1><p>The cat sat on the mat and it was a very long day for all of the people in the town.</p>"
           "<p>The second part of the story is also long, and it has the words that are needed for that.</p>")
ARTICLE_TEXT = ("Title The cat sat on the mat and it was a very long day for all of the people in the town. "
                "The second part of the story is also long, and it has the words that are needed for that.")
REMARKS = "".join(f"<div class=comment>And I think that it is one of the best that I have read in the last {n} years.</div>" for n in range(9))


@pytest.mark.parametrize("wrapped", [
    "<form>%s</form>", "<form><article>%s</article></form>", "<div class='right-sidebar'><article>%s</article></div>",
    "<div class='page-with-sidebar'>%s</div>", "<form><div id=sidebar-page>%s</div><nav>one two</nav></form>",
    "<article><section class='comment-on-politics'>%s</section></article>", "<svg/>%s", "<math />%s", "<article>%s</article><svg/>",
    "<div class=x'>%s</div>", "<div title='a > b' class=\"x\">%s</div>", "%s<div class=comments>" + REMARKS + "</div>",
    "<article>%s</article><section id=comments>" + REMARKS + "</section>",
    "%s<form>" + REMARKS.replace("div class=comment", "p") + "</form>", "%s<aside>" + ARTICLE * 5 + "</aside>"])
def test_wrappers_of_a_whole_page(wrapped):
    page = f"<html><body><nav><a href=/>home</a> about</nav>{wrapped.replace('%s', ARTICLE)}<footer>the end of it</footer></body></html>"
    assert main_text(page) == ARTICLE_TEXT


def test_time_is_linear_in_nesting():
    for part in ("<div>", "<div class=ad>", "<a>x", "<span class=ad>x", "<h1>", "<li>", "<p", "<a href='", "<a b=", "</x>"):
        start = time.perf_counter()
        main_text(part * 40_000)
        assert time.perf_counter() - start < 5
    start = time.perf_counter()
    assert main_text("<div>" * 40_000 + "x" + "</div>" * 40_000) == "x" and time.perf_counter() - start < 5


def test_near_classes(spark):
    docs = documents(spark).select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)
    words = dict(zip(ids, _word_lists(pa.array([texts[i] for i in ids]))))
    label = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and label[a] != label[b] and similar(words[a], words[b], 0.8):
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    assert {r.doc_id: r.class_id for r in near_dedup(docs).collect()} == label


def test_near_crowd(spark):
    """A chain of small edits is one class; half-similar texts stay apart."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows, last = [], base
    for i in range(40):
        last = [f"n{rng.random()}" if rng.random() < 0.01 else w for w in last]
        rows.append((i, " ".join(last)))
    for i in range(40, 60):
        rows.append((i, " ".join(base[:100] + [f"u{rng.random()}" for _ in range(100)])))
    got = near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got if r.doc_id < 40} == {0}
    assert {r.class_id for r in got if r.doc_id >= 40} == set(range(40, 60))


def test_near_half_similar_crowd(spark):
    """Few pairs of 0.8 to 0.9 in a crowd around one template, found by all keys, against all pairs."""
    rng = random.Random(11)
    template = [f"t{i}" for i in range(150)]
    texts = []
    for i in range(150):
        own = [f"o{i}x{j}" for j in range(50)]
        texts.append(" ".join(template + own))
        if i % 3 == 0:
            changed = rng.sample(range(50), 4)
            texts.append(" ".join(template + [f"e{i}x{j}" if j in changed else w for j, w in enumerate(own)]))
    rng.shuffle(texts)
    words = _word_lists(pa.array(texts))
    near = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if similar(words[a], words[b], 0.8)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup(docs).collect()}
    assert len(near) >= 40 and sum(got[a] == got[b] for a, b in near) >= 0.95 * len(near)
    assert all(i == c or (c, i) in near for i, c in got.items())


@pytest.mark.parametrize("block", [4096, 40])
def test_near_crowd_around_the_similarity(spark, monkeypatch, block):
    """A crowd just below the similarity, where only some pairs are above it, equals all pairs."""
    rng = random.Random(5)
    template, texts = [f"t{i}" for i in range(200)], []
    for i in range(150):
        changed = rng.sample(range(200), 3)
        texts.append(" ".join(f"c{i}x{j}" if j in changed else w for j, w in enumerate(template)))
    words = _word_lists(pa.array(texts))
    label = list(range(len(texts)))
    near = [(a, b) for a in label for b in label[a + 1:] if similar(words[a], words[b], 0.8)]
    assert 0 < len(near) < 500
    for _ in texts:
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
    assert 10 < len(set(label)) < 140
    monkeypatch.setattr(neardup, "BLOCK", block)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup(docs).collect()}
    assert got == dict(enumerate(label))


def thue_morse(a: str, b: str, n: int) -> list[str]:
    out = [a]
    while len(out) < n:
        out += [b if x == a else a for x in out]
    return out


def test_regular_patterns_do_not_collide(spark):
    """Sums of powers modulo 2^64 cancel on these, whatever the base."""
    x, y = "".join(thue_morse("a", "b", 4096)), "".join(thue_morse("b", "a", 4096))
    tail = " ".join(f"t{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"{x} {tail}"), (2, f"{y} s {tail[:40]}"), (3, " ".join(thue_morse("u", "v", 4096))),
                                  (4, " ".join(thue_morse("v", "u", 4096))), (5, x), (6, y)], "doc_id long, text string")
    assert [r.class_id for r in near_dedup(docs).orderBy("doc_id").collect()][4:] == [5, 6]
    data, offsets = utf8(pa.array([x, y]))
    for lane in (0, 1):
        assert len(set(span_hash(data, offsets[:-1], offsets[1:], lane).tolist())) == 2
        words = np.array([1, 2], np.uint64)
        orders = np.concatenate([words[[int(c == "a") for c in s]] for s in (x, y)])
        assert len(set(sequence_hash(orders, offsets[:-1], offsets[1:], lane).tolist())) == 2
    window = " ".join(f"k{i}" for i in range(19))
    single = spark.createDataFrame([(1, f"{x} {window}"), (2, f"{y} {window}")], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup(single).collect()] == [0, 0]


def test_near_odd(spark, odd, empty):
    got = near_dedup(odd)
    rows = collections.Counter((r.doc_id, r.class_id, r.kept) for r in got.collect())
    assert rows == {(None, None, True): 1, (1, 1, True): 1, (2, 1, False): 1, (3, 1, False): 1, (4, 4, True): 2, (5, 5, True): 1,
                    (6, 5, False): 2, (7, 7, True): 1, (8, 1, False): 1}
    assert near_dedup(empty).count() == 0


def test_edits():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, old = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(old[j] + (x != y), old[j + 1] + 1, row[j] + 1))
        return row[-1]

    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(12))] for _ in range(2))
        assert [edits_within(a, b, k) for k in range(13)] == [plain(a, b) <= k for k in range(13)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), *((30 + i, 31 + i) for i in range(25))]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 7, 8, 9), 1), 20: 20, 21: 20, **{30 + i: 30 for i in range(26)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_contamination(spark, odd, empty):
    item = "If Alice has 12 apples and gives 5 km of rope to Bob then Alice walks 12 miles home quickly today"
    items = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (None, "six plain words make this item")], "item_id long, text string")
    rows = [(1, f"Yesterday I read: {item}. The end."), (2, item.replace("Alice", "Carol Jones").replace("12", "30").replace("Bob", "Dave")),
            (3, item.replace("If Alice", "If Erin").replace("Bob", "Dave").replace("walks 12", "walks 31")), (4, item.upper()), (8, item.lower()), (9, item.replace(" Alice", "\nAlice").replace(" Bob", "\nBob")),
            (10, item.upper().replace("12", "30")), (5, "Nothing of the kind is found in here."), (6, None),
            (None, f"see six plain words make this item {item}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.id), str(r.item_id), r.changed) for r in contamination(docs, items).collect())
    assert got == [("1", "7", False), ("10", "7", True), ("2", "7", True), ("4", "7", False), ("8", "7", False), ("9", "7", False),
                   ("None", "7", False), ("None", "None", False)]
    assert sorted(str(r.doc_id) for r in decontaminate(docs, items).collect()) == ["3", "5", "6"]
    assert contamination(odd, items).count() == 0 and contamination(empty, items).count() == 0
    assert contamination(docs, items.limit(0)).count() == 0


def test_contamination_numeric_items(spark):
    """Items full of numbers and units are found as they stand; other values in the dense part are no evidence."""
    texts = ["What is 3 + 4 * 5 - 6 / 2 ?", "Find the mean of 12, 15, 18, 21, 24, 27 and 30 and round it to one decimal.",
             "A 5 kg block moves 3 m in 2 s and a 7 kg block moves 4 m in 6 s. Which one is faster?"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [*((i, f"so here we read: {t} and go on with it") for i, t in enumerate(texts)), (3, "What is 8 + 1 * 9 - 7 / 5 ?"),
            (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.id, r.item_id, r.changed) for r in contamination(docs, items).collect())
    assert got == [(0, 0, False), (1, 1, False), (2, 2, False)]


def test_contamination_finds_the_items(spark):
    docs, items = documents(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want, known = set(), collections.defaultdict(set)
    for r in items.collect():
        words = r.text.lower().split()
        n = min(13, len(words))
        for i in range(len(words) - n + 1):
            known[tuple(words[i:i + n])].add(r.item_id)
    for r in docs.collect():
        words = r.text.lower().split()
        for n in {len(k) for k in known}:
            want |= {(r.doc_id, item) for i in range(len(words) - n + 1) for item in known.get(tuple(words[i:i + n]), ())}
    assert {(r.id, r.item_id) for r in contamination(docs, items).collect()} == want and want


def test_pipeline(spark):
    import corpus_pipeline

    docs = documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality_rules(docs).where("kept").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
    small = {r.doc_id for r in docs.collect() if len(brute.WORD.findall(r.text)) < 20}
    lost = good - small - {r.doc_id for r in kept.collect()}
    assert len(lost) <= 0.02 * len(good)
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and 0 < out.count() < docs.count()


def test_odd_column_names(spark):
    frame = spark.createDataFrame([(1, "some words in a row", 7, 8)], "doc_id long, text string, `a b` int, KEPT int")
    for out in (quality_rules(frame), near_dedup(frame), substring_dedup(frame), count_tokens(frame, BYTES), encode_pieces(frame, PIECES)):
        assert out.first()["a b"] == 7 and len({c.lower() for c in out.columns}) == len(out.columns)


def test_every_operator_is_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
