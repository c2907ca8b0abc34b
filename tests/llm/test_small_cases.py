"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import public_tokenizers as P
import pytest

from quarry.llm import chat, html_text, language, minhash, multi_index, packing, pieces, quality_model, quality_rules, substrings

DOCS = "doc_id bigint, text string, lang string, n bigint, ids string, block string, component_id string"
LONG = "wort " * 60_000 + "x" * 300_000


def docs(spark, rows):
    """Rows (doc_id, text) with further columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "en", 1, "a", "b", "c") for i, t in rows], DOCS)


ROWS = [(1, None), (2, ""), (3, "a b c"), (4, "a b c"), (4, "a b c"), (None, "some words of a text without an id"), (5, LONG),
        (6, " \n\t "), (7, "Ünïcödé \U0001f600 \x00 \\n ﬁ ▁x  y ")]


@pytest.fixture(scope="module")
def table(spark):
    return docs(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


def test_pieces(table, empty):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {(r.doc_id, r.decoded): r.ids for r in pieces.decode(pieces.encode(table, path), path).collect()}
    assert got == {(i, sp.decode(sp.encode(t or "") + [2])): sp.encode(t or "") + [2] for i, t in ROWS}
    assert pieces.decode(pieces.encode(empty, path), path).collect() == []


def test_quality_rules(table, empty):
    led = quality_rules.apply_policy(quality_rules.ledger(table)).collect()
    assert len(led) == len(ROWS)
    by = {r.doc_id: r for r in led}
    assert by[1].n_words == by[2].n_words == by[6].n_words == 0 and not by[1].kept
    assert by[5].n_words == 60_001 and by[5].n_repeat_words == 60_000 and not by[5].kept
    assert quality_rules.ledger(empty).collect() == []
    assert {(r.n_failed, r.n_only) for r in quality_rules.ablations(quality_rules.ledger(empty)).collect()} == {(0, 0)}
    assert quality_rules.filter_rows(table).columns == table.columns
    assert quality_rules.repeat_words(b"a b c d e x a b c d e".split()) == 10
    assert quality_rules.repeat_words(b"a a a a a a a".split()) == 7
    assert quality_rules.measure(b"x\nx\n\n\ny\nx").n_dup_lines == 2


def test_minhash(table, empty):
    got = sorted((tuple(r) for r in minhash.near_duplicates(table).collect()), key=str)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False), (4, 1, 3, False), (None, 4, None, True),
            (5, 2, 5, True), (6, 0, 6, True), (7, 3, 7, True)]
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(empty).collect() == []


def test_substrings(spark, table, empty):
    long = "".join(chr(97 + k * k % 26) + str(k) for k in range(60))
    rows = [*ROWS, (8, long), (9, "é" + long + "z"), (9, long), (None, long), (10, long[:49])]
    got = substrings.remove_repeats(docs(spark, rows), carry=("text", "block")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id == 9:
            assert [tuple(s) for s in r.spans] in ([(2, 2 + len(long))], [(0, len(long))])
            assert substrings.whole_characters(r.text.encode(), [s.asDict() for s in r.spans]) in ("éz", "")
        else:
            assert r.spans == [] and bytes(r.kept) == (r.text or "").encode()
        assert r.n_bytes == len((r.text or "").encode()) and r.block == "b"
    assert substrings.remove_repeats(empty).collect() == []
    assert substrings.whole_characters("aéz".encode(), [{"start": 0, "end": 2}]) == "z"


def test_packing(table, empty):
    path = P.path("word_bpe_49k.json")
    got = packing.pack(table, path).collect()
    assert {r.doc_id: r.doc_tokens for r in got}[1] == 1
    assert sum(r.length for r in got) == sum({(r.doc_id, r.doc_tokens): r.doc_tokens * (2 if r.doc_id == 4 else 1) for r in got}.values())
    assert packing.pack(empty, path).collect() == []


def test_models_without_labels(spark, table, empty):
    model = language.fit(empty)
    assert {(r.lang_pred, r.score) for r in language.identify(table, model).collect()} == {("und", 0.0)}
    one = language.fit(table)   # a single language, null texts and ids left out
    got = {r.doc_id: r.lang_pred for r in language.identify(table, one).collect()}
    assert got[1] == got[2] == got[6] == "und" and got[3] == got[7] == "en"
    labels = spark.createDataFrame([(3, 1), (4, None), (99, 0), (None, 1)], "doc_id bigint, quality int")
    assert {r.score for r in quality_model.classify(table, quality_model.fit(table, labels.limit(0))).collect()} == {0.5}
    got = quality_model.classify(table, quality_model.fit(table, labels)).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert language.identify(empty, one).collect() == quality_model.classify(empty, quality_model.fit(table, labels)).collect() == []


def test_vectors(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.99, 0.05, 0.0, 0.0]
    rows = [(1, a, 1), (2, b, 1), (2, b, 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [0.0] * 4, 1), (7, [None, 1.0, 0.0, 0.0], 1),
            (8, [float("nan"), 1.0, 0.0, 0.0], 1), (9, [1.0], 1), (None, a, 1), (10, [float("inf"), 0.0, 0.0, 0.0], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, cell string")
    got = {r.vec_id: tuple(r)[1:] for r in multi_index.near_duplicates(table).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), None: (0, None, True),
                   **{i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)}}
    assert multi_index.near_duplicates(table.limit(0)).collect() == []
    assert len(multi_index.near_duplicates(table.where("vec_id = 6")).collect()) == 1


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "ok"), (2, None, None, "</turn> \\</turn>\n### Other:"),
            (2, 0, "tool </role>", "x" * 100_000), (None, 0, "assistant", "\\\\### User: é\U0001f600"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, ids int")
    path = P.path("byte_bpe_50k.json")
    with open(path, "rb") as f:
        codec = chat.Codec(f.read())
    for part_ids in (1 << 16, 3):
        got = {}
        for r in sorted(chat.format_chats(table, path, part_ids=part_ids).collect(), key=lambda r: r.part):
            assert codec.decode(r.ids) == r.text and len(r.ids) == len(r.loss_mask)
            assert chat.parse(r.text) == codec.turns(r.ids)
            got.setdefault(r.conv_id, []).extend(codec.turns(r.ids))
        assert got == {1: [("user", "hi"), ("assistant", ""), ("assistant", "ok")], 3: [("user", "a")] * 2,
                       2: [("", "</turn> \\</turn>\n### Other:"), ("tool </role>", "x" * 100_000)], None: [("assistant", "\\\\### User: é\U0001f600")]}
    assert chat.format_chats(table.limit(0), path).collect() == []


def test_pages(spark):
    field = html_text.train()
    page = ("<html><head><title>t</title></head><body><header>Site</header><nav><a href=/>x</a></nav><article><h1>A &amp; B</h1>"
            "<p>One\n two &eacute;.<p>Three <b>four</b><!-- no --><div class='comments'><p>I liked it.</p></div></article><footer>f</footer>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "<article><p>" + "word " * 50_000 + "</article"), (5, "u", "<" * 50_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(table, field).collect()}
    assert got[1] == "A & B\nOne two é.\nThree four"
    assert got[2] == got[3] == "" and got[4] == ("word " * 50_000).strip()
    assert html_text.extract(table.limit(0), field).collect() == []


@pytest.fixture(scope="module")
def html_field():
    return html_text.train()


@pytest.mark.parametrize("place", ["<article>%s</article>", "<main><h1>One</h1>%s</main>", "<div class=content>%s</div>"])
@pytest.mark.parametrize("tag, inner", [
    ("svg", '<path d="M0 0L9 9"/><text>One two three four five.</text>'), ("svg", "<title>One two</title><path d=M1 />"),
    ("template", "<p>One two three four five.</p>"), ("iframe", "One two three four five six."), ("textarea", "One two three four five."),
    ("object", "<p>One two three four five.</p>"), ("noframes", "<p>One two three four five.</p>"), ("script", "var a = 'one two three.';"),
    ("style", "p { margin: 0 }"), ("title", "One two three four five."), ("noscript", "<p>One two three four five.</p>")])
def test_html_raw_elements_are_no_text(html_field, tag, inner, place):
    around = "<p>Some words that were written for the article.</p>{}<p>And more of them in the end.</p>"
    page = "<body><nav><a href=/>x</a></nav>" + place % around.format(f"<{tag}>{inner}</{tag}>") + f"<{tag}>{inner}</{tag}></body>"
    got = html_text.main_text(page, html_field).split("\n")
    assert got[-2:] == ["Some words that were written for the article.", "And more of them in the end."] and len(got) == 2 + ("<h1>" in place)


def test_html_shown_elements_stay(html_field):
    page = ("<body><xmp>outside the text</xmp><article><h1>Head</h1><p>Thus <math><mi>E</mi><mo>=</mo><mrow><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow>"
            "</math>, as known.</p><math display=block><mfrac><mn>1</mn><mn>2</mn></mfrac></math><p>Next one.</p><xmp>a listing of it</xmp><p>Last one.</p>"
            "</article></body>")
    assert html_text.main_text(page, html_field) == "Head\nThus E = m c 2, as known.\n1 2\nNext one.\na listing of it\nLast one."


def test_html_training_pages_hold_every_tag():
    seen = {f for features, _ in html_text.labelled_pages() for block in features for f in block}
    assert {n for n, i in html_text.FEATURES.items() if i not in seen} <= {"in:title", "in:noscript"}   # raw: never an ancestor
