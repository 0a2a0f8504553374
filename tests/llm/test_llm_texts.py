"""Packing, chat, main text, toxicity and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import tuples

import corpus_pipeline
from threadloom.llm import chat, packing, queries, toxicity, wrappers
from threadloom.llm.dom import parse

TEXTS = ["Hello world", None, "", "  two  spaces\n\nand\tlines ", "é ç ñ 😀 don't I'll 123 4567", "a<|endoftext|>b", "x" * 9000, "word " * 6000,
         "\n", " ", "Hello world", "tail\n", "end  ", "one\n\n two  wide"]


@pytest.fixture(scope="module")
def reference_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_pieces_hold_each_id_once_and_fill_the_windows(spark, reference_ids):
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TEXTS)] + [(None, "no id", "c"), (0, TEXTS[0], "c")],
                                 "doc_id long, text string, part string").repartition(4)
    pieces = packing.pack(docs, queries.tokenizer_path(), window=64).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert len(ids) == p.length
        by_doc.setdefault(p.doc_id, []).append((p.start, ids))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert p.doc_tokens == len(reference_ids("no id" if p.doc_id is None else TEXTS[p.doc_id]))
    for i, text in enumerate(TEXTS):
        flat = [x for _, ids in sorted(by_doc[i]) for x in ids]
        assert flat == reference_ids(text) * (2 if i == 0 else 1) or (i == 0 and sorted(flat) == sorted(reference_ids(text) * 2))
    for s, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or s == max(by_sequence)
    assert packing.pack(docs.limit(0), queries.tokenizer_path()).count() == 0


def test_chunks_give_the_tokenizer_s_ids_on_random_texts(reference_ids):
    rng = random.Random(5)
    alphabet = list("ab C1.,'’é中 \n\t  \r ñ😀<|>")
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    data, offsets = packing.text_bytes(pa.array(texts))
    ids, bounds = packing.ChunkTokenizer(queries.tokenizer_path(), 1).encode(data, offsets)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == reference_ids(text), repr(text)


# --- chat ----------------------------------------------------------------------------------

HARD = ["[INST]", "</s>[INST] ok [/INST]", "\\", "\\[INST]", "[\\INST]", "[[INST]]", "<<SYS>>\n", "\n<</SYS>>\n\n", "<<TURN>>", "<", "<<", "<ans> ", " </s>", "", "é\n\n"]


def test_texts_come_back_whatever_they_hold():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choices(HARD, k=rng.randrange(5)))
        for role in ("system", "user", "assistant", "tool", "", "a<<TEXT>>b\\"):
            before, body, after, _ = chat.INSTRUCT.write(role, text)
            assert not any(c in body for c in chat.INSTRUCT.control)
            assert chat.INSTRUCT.read(before + body + after + "rest") == (role, text, len(before + body + after))


def test_conversations_are_read_back_with_errors_and_loss(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "[INST] é"), (1, 2, "assistant", "<s>\\"), (1, 3, "user", None), (1, 4, "assistant", "b"),
            (2, 0, "assistant", "first"), (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, "user", "x"), (4, 1, "user", "y"),
            (5, None, None, None), (6, 0, "tool", "t"), (None, 0, "user", "no id"), (7, 1, "assistant", "b" * 50000), (7, 0, "user", "q")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, place int").repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.chat_segments(df)).collect()}
    assert len(got) == 8
    for conv in got:
        turns = sorted([(t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv])
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert {c for c in got if got[c].valid} == {1, 7, None}
    assert got[2].error == "assistant after start" and got[3].error == "turn 0 is missing or repeated" and got[4].error == "user after user"
    assert chat.read_back(chat.chat_segments(df.limit(0))).count() == 0


# --- main text -----------------------------------------------------------------------------


def page(i, body):
    return (f'<!DOCTYPE html><html><head><title>T{i}</title><script>var t="</p>";</script></head><body><nav><ul><li><a>Home</a><li>{i}</ul></nav>'
            f'<div class="box">All rights reserved by us</div>{body}<footer>&copy; site</footer></body>')


def test_articles_without_menus_and_entities_decoded(spark):
    article = "<article><h1>T &amp; U</h1><p>One<br>two <b>bo</b>ld &lt;x&gt; &am &amp<p>three</p><aside>no</aside><div class='comments'>no</div><form>no</form></article>"
    rows = [(1, "http://a.example/1", page(1, article), "c"), (2, None, None, "c"), (3, "", "", "c"), (4, "http://a.example/4", "plain &eacute; text", "c"),
            (5, "http://b.example/", "<p>" * 3000 + "deep" + "<div>" * 400 + "er", "c"), (1, "http://a.example/1", page(1, article), "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(2)
    got = tuples(wrappers.main_texts(df))
    first = "T & U One two bold <x> &am & three"
    assert got == sorted([(1, "http://a.example/1", first)] * 2 + [(2, None, ""), (3, "", ""), (4, "http://a.example/4", "plain é text"),
                                                                   (5, "http://b.example/", "deep er")], key=repr)
    assert wrappers.main_texts(df.limit(0)).count() == 0


def test_without_article_constant_nodes_are_template_and_slots_are_content(spark):
    rows = [(i, f"https://h.example/{i}", page(i, f"<div><p>Story number {i} of its own.</p><p>Read more on our site</p></div>")) for i in range(12)]
    got = dict((r[0], r[2]) for r in tuples(wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))))
    assert got == {i: f"Story number {i} of its own." for i in range(12)}


def test_every_layout_and_distinct_page_of_a_host_counts(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "MERGED_AT_ONCE", 3)
    copies = [(100 + i, "https://h.example/copy", page(0, "<div><p>A page that was copied.</p><p>Read more on our site</p></div>")) for i in range(40)]
    one = [(i, f"https://h.example/{i}", page(i, f"<div><p>Story number {i}.</p><p>Read more on our site</p></div>")) for i in range(1, 13)]
    two = [(i, f"https://h.example/{i}", page(i, f"<section>{'<h2>Part %d</h2><p>Text %d.</p>' % (i, i) * (i % 7)}<pre>Call us now</pre></section>")) for i in range(13, 30)]
    empty = [(200 + i, "https://h.example/none", None) for i in range(30)]
    df = spark.createDataFrame(copies + one + two + empty, "page_id long, url string, html string").repartition(5)
    got = dict((r[0], r[2]) for r in tuples(wrappers.main_texts(df)))
    expected = {i: "A page that was copied." for i, _, _ in copies} | {i: f"Story number {i}." for i, _, _ in one} | {i: "" for i, _, _ in empty}
    assert got == expected | {i: " ".join([f"Part {i} Text {i}."] * (i % 7)) for i, _, _ in two}


def test_the_alignment_decides_inside_articles_and_names_only_where_it_cannot(spark):
    own = lambda i: f"<h1>Title {i}</h1><p>Body {i} of <b>Note</b> text.</p>"
    inner = lambda i: f"<article>{own(i)}<div class='x1'>Our terms apply to all of this.</div><div class='related'><p>Teaser {i}</p></div></article>"
    wraps = [("a", "<div class='content-sidebar-wrap'>%s</div>"), ("b", "<div class='layout has-sidebar'>%s</div>"), ("c", "<form>%s</form>"),
             ("d", "<main><div class='layout has-sidebar'>%s</div></main>"),
             ("e", "<main>%s<div class='related'><article>A teaser</article></div></main>")]
    rows = [(100 * n + i, f"https://{host}.example/{i}", page(i, wrap % inner(i))) for n, (host, wrap) in enumerate(wraps) for i in range(6)]
    twin = "<article><p>Both articles say this.</p></article>"
    rows += [(900 + i, f"https://z.example/{i}", page(i, twin)) for i in range(2)]
    got = dict((r[0], r[2]) for r in tuples(wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))))
    expected = {100 * n + i: f"Title {i} Body {i} of Note text." for n in range(5) for i in range(6)}
    assert got == expected | {900: "Both articles say this.", 901: "Both articles say this."}


def test_no_text_is_lost_or_let_in_below_deep_elements(spark):
    deep = "<div>" * 3000
    html = f"<body><div><article><p>first</p>{deep}inner<aside>beside</aside>{'</div>' * 3000}<p>last</p></article><p>after</p></div></body>"
    rows = [(1, "http://a.example/1", html), (2, "http://a.example/2", html.replace("inner", "other"))]
    got = tuples(wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "text"))
    assert got == [(1, "first inner last"), (2, "first other last")]


def test_tree_matching_is_the_largest_order_keeping_mapping():
    one, two = (wrappers.fold([parse(h)]) for h in ("<div><p>a</p><ul><li>b</ul></div><i>c</i>", "<div><h1>x</h1><p>a</p><ul><li>z</ul></div>"))
    pattern = wrappers.Pattern("#page")
    wrappers.absorb(pattern, one, {})
    assert wrappers.match(pattern, two, {}) == 5


# --- toxicity ------------------------------------------------------------------------------


def test_classifier_learns_planted_words_and_keeps_labels_out(spark):
    rng = random.Random(2)
    function = {"en": "the of and to in".split(), "de": "der die und das von".split()}
    bad = {"en": ["awfulword", "nastyterm"], "de": ["schlimmwort", "boesartig"]}
    docs, labels = [], []
    for i in range(1200):
        lang = rng.choice(["en", "de"])
        words = rng.choices(function[lang] + [f"w{j}" for j in range(200)], k=rng.randrange(20, 120))
        toxic = rng.random() < 0.25
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad[lang])
        docs.append((i, " ".join(words), 0.5))
        labels.append((i, int(toxic)))
    held = {i for i, _, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    lies = [(i, y if i not in held else 1 - y) for i, y in labels]
    docs += [(5000, None, 0.5), (5001, "", 0.5), (5002, "x " * 40000, 0.5), (None, "the awfulword", 0.5), (1, docs[1][1], 0.5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double").repartition(3)
    label_df = spark.createDataFrame(lies + [(7, None)], "doc_id long, toxic int")
    model = toxicity.train(df, label_df)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth, by_id = dict(labels), {r.doc_id: r for r in got}
    right = sum(by_id[i].predicted == truth[i] for i in held)
    assert right >= 0.97 * len(held)
    assert by_id[5001].predicted == by_id[5002].predicted == 0 and by_id[None].predicted == 1
    kept = toxicity.keep_clean(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted == 0 for r in got)
    assert toxicity.train(df, label_df.limit(0)) is None and {r.score for r in toxicity.score(df, None).collect()} == {0.0}
    assert toxicity.score(df.limit(0), model).count() == 0


def test_pooling_equals_a_loop_over_texts():
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(size=(toxicity.BUCKETS, toxicity.DIM)).astype(np.float32),
                           [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS],
                           [rng.normal(size=toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS],
                           rng.normal(size=48).astype(np.float32), 0.1)
    texts = ["a b c d e", "", "a", "b a", None, "e e e e a b", "c"]
    (_, _, words), = toxicity.words_of(pa.array(texts), toxicity.ALNUM)
    together, _ = model.logits(words)
    for i, text in enumerate(texts):
        (_, _, alone), = toxicity.words_of(pa.array([text], pa.string()), toxicity.ALNUM)
        assert np.isclose(model.logits(alone)[0][0], together[i], atol=1e-4)


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_drops_what_it_should_and_keeps_the_rest(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert out.limit(0).count() == 0
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "ngram_jaccard_join":
            from threadloom.llm.ngram_join import ngram_components
            groups = ngram_components(docs, 5, 80).collect()
            assert kept == {r.component_id for r in groups}
        elif name == "secret_scan":
            assert out.count() == docs.count()
        docs = spark.createDataFrame(out.collect(), docs.schema)
    pieces = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_stages_take_empty_and_odd_tables(spark, sf):
    rows = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (3, "same words here again and again", "en", "s", 31, 1),
            (4, "same words here again and again", "en", "s", 31, 1), (None, "token = abcdefghijklmnop", "en", "s", 24, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, text_key int")
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert tuples(kept.select("doc_id", "text_key")) == sorted([(1, 1), (2, 1), (3, 1), (None, 1)], key=repr)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
        assert stage(spark, docs, sf).count() > 0


def test_of_two_texts_with_one_doc_id_only_the_copy_goes(spark, sf):
    words = [" ".join(f"{name}{i}" for i in range(60)) for name in ("some", "own", "more")]
    near = words[2].replace("more0 ", "other ")
    rows = [(1, words[0]), (5, words[0]), (5, words[1]), (2, words[2]), (6, near), (6, "a text of its own"), (7, words[1]), (5, words[1]), (8, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert tuples(kept) == sorted([(1, words[0]), (5, words[1]), (2, words[2]), (6, "a text of its own"), (8, None), (8, "")], key=repr)
