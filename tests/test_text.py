"""Sentence, n-gram and tokenizer behaviour on small hand-made inputs."""

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import ngrams as NG


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("x")).first().x


def test_sentence_split_keeps_empty_pieces(spark):
    assert one(spark, T.sentences, "a b. c d. ") == ["a b", "c d", ""]
    assert one(spark, T.sentences, "no break.here") == ["no break.here"]


def test_normalize_is_ascii_word_runs(spark):
    assert one(spark, T.normalize_sentence, "Héllo, World_1!  x") == "h llo world_1 x"


def test_ngrams_split_at_underscore_and_skip_short(spark):
    df = spark.createDataFrame([("a_b c",), ("x",), ("",)], "s string")
    got = df.select(T.ngrams(T.ngram_words(F.col("s")), 2).alias("g")).collect()
    assert [r.g for r in got] == [["a b", "b c"], [], []]
    one_grams = df.select(T.ngrams(T.ngram_words(F.col("s")), 1).alias("g")).collect()
    assert one_grams[2].g == [""]          # an empty sentence gives one empty 1-gram


def test_top_ngrams_ties_by_ngram(spark):
    paras = spark.createDataFrame([(1, "b a. a b. c c")], "doc_id long, text string")
    counts = NG.ngram_counts(NG.corpus_sentences(paras), (1,))
    top = NG.top_ngrams(counts, 2).orderBy("rnk").collect()
    assert [(r.ngram, r.cnt) for r in top] == [("a", 2), ("b", 2)]


def test_tokenizer_classes(spark):
    toks = one(spark, T.tokenize, "Call (555) 123-4567 @Bob #New-York don't 3.14 ... . :D <br> x")
    assert toks == ["call", "(555) 123-4567", "@bob", "#new-york", "don't", "3.14", "... .", ":d", "<br>", "x"]


def test_urls_keep_case_emoticons_do_not(spark):
    toks = one(spark, T.tokenize, "See HTTPS://Ex.COM/A :P")
    assert toks == ["see", "HTTPS://Ex.COM/A", ":p"]


def test_amp_alone_is_kept(spark):
    assert one(spark, T.tokenize, "you &amp; me") == ["you", "&", "amp", ";", "me"]


def test_amp_with_other_entity_becomes_and(spark):
    assert one(spark, T.unescape_entities, "a &amp; b &lt;c&gt; &#8230;") == "a  and  b <c> …"


def test_unknown_and_out_of_range_entities_stay(spark):
    assert one(spark, T.unescape_entities, "&foo; &#99999999999; &#65;") == "&foo; &#99999999999; A"


def test_ellipsis_is_one_token(spark):
    assert one(spark, T.tokenize, "wait…") == ["wait", "…"]


def test_tokens_cover_every_non_blank_character(spark):
    """Property: the tokens, blanks removed, spell the text, blanks removed."""
    import random
    rnd = random.Random(17)
    alphabet = list("abcXYZ019 .,;:!?'-_#@()<>/=&*[]{}|\\\"\n\t") + ["é", "ß", "…", "ç", "8"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    texts = [t.replace("&", "") for t in texts]   # entities change the text; tested separately
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select("s", T.tokenize(F.col("s")).alias("t")).collect()
    blank = set(" \n\t")
    for r in got:
        joined = "".join(r.t)
        assert "".join(ch for ch in joined if ch not in blank).lower() == \
            "".join(ch for ch in r.s if ch not in blank).lower(), r.s


def test_top_ngrams_threshold_edges(spark):
    rows = [(1, "a", 5), (1, "b", 3), (1, "c", 3), (1, "d", 3), (1, "e", 1),   # ties at the k-th count
            (2, "x y", 2)]                                                     # fewer than k n-grams
    counts = spark.createDataFrame(rows, "n int, ngram string, cnt bigint")
    got = [(r.n, r.rnk, r.ngram, r.cnt) for r in NG.top_ngrams(counts, 3).orderBy("n", "rnk").collect()]
    assert got == [(1, 1, "a", 5), (1, 2, "b", 3), (1, 3, "c", 3), (2, 1, "x y", 2)]


def test_long_runs_of_dots_and_leading_zeros(spark):
    from pyspark.sql import functions as F

    from quarry.functions.text import tokenize, unescape_entities
    dots = "." * 100_000
    row = spark.createDataFrame([(dots, ". . .. " * 5_000 + "x", "&#000000065;&#0;&#99999999999999999999;")], "a string, b string, c string") \
        .select(tokenize(F.col("a")).alias("a"),
                tokenize(F.col("b")).alias("b"),
                unescape_entities(F.col("c")).alias("c")).first()
    assert row.a == [dots] and row.b[-1] == "x" and len(row.b) == 2
    assert row.c == "A\x00&#99999999999999999999;"


def test_ngrams_split_their_words_once(spark):
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(3000)),), ("a",), (None,)], "s string")
    grams = df.select("s", T.ngrams(T.ngram_words(F.col("s")), 3).alias("g"))
    plan = grams._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1, plan
    got = {r.s: r.g for r in grams.collect()}
    assert len(got.pop(max((k for k in got if k), key=len))) == 2998 and got == {"a": [], None: []}


def _rows_of_blocks(sentences, ns):
    """The counts as a cluster makes them: pieces of two tasks' blocks, then whole buckets in order."""
    import pyarrow as pa
    lines = [pa.RecordBatch.from_arrays([pa.array([s + "\n" for s in part])], ["line"]) for part in (sentences[::2], sentences[1::2])]
    packed = [b for x in lines for b in NG._block_pieces([x], ns)]
    dealt = pa.Table.from_batches(packed).sort_by("bucket").to_batches(max_chunksize=3)
    got = pa.Table.from_batches(NG._bucket_counts(dealt, ns)).to_pylist()
    return packed, [(r["n"], r["ngram"], r["cnt"]) for r in got]


def test_ngram_counts_in_small_blocks(spark, monkeypatch):
    import collections
    import random
    rnd = random.Random(3)
    sentences = [" ".join(rnd.choice(["a", "b", "cc", ""]) for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    for ns in ((1, 2, 3, 4, 5), (2,), (1, 4), (7,)):
        want = collections.Counter((n, " ".join(w[i:i + n])) for w in (s.split(" ") for s in sentences) for n in ns
                                   for i in range(len(w) - n + 1))
        for block, batch in ((8 << 20, 1 << 20), (50, 7)):
            monkeypatch.setattr(NG, "BLOCK_BYTES", block)
            monkeypatch.setattr(NG, "BATCH", batch)
            got = _rows_of_blocks(sentences, ns)[1]
            assert {(n, g): c for n, g, c in got} == want and len(got) == len(want)   # each n-gram in one row


def test_ngram_counts_shuffle_one_window_per_position(spark):
    """A position's n-grams of all lengths above two leave its block as one window, a repeated sentence's once."""
    words = [f"w{i}" for i in range(1000)]
    packed, _ = _rows_of_blocks([" ".join(words)] * 50, (1, 2, 3, 4, 5))
    pieces = sum(len(x) // 8 for b in packed for x in b.column("counts").to_pylist())
    assert pieces == 2 * (1000 + 999 + 998)   # in each of the two blocks: words, pairs, windows


def test_ngram_counts_shuffle_is_dense(monkeypatch):
    """Common words are spelled short and the blocks' pieces of a bucket compressed together, with the same counts."""
    import collections
    import random
    import pyarrow as pa
    rnd, ns = random.Random(5), (1, 2, 3, 4, 5)
    words = ["".join(rnd.choices("abcdefgh0123", k=rnd.randint(2, 9))) for _ in range(400)] + ["", "a"]
    sentences = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30))) for _ in range(6000)]
    monkeypatch.setattr(NG, "BUCKETS", 64)
    lines = pa.RecordBatch.from_arrays([pa.array([s + "\n" for s in sentences])], ["line"])
    monkeypatch.setattr(NG, "BLOCK_BYTES", lines.nbytes // 3)
    common = NG._common_words([s + "\n" for s in sentences[:500]])
    assert len(common[0]) > 300 and not set(common[0].to_pylist()) & set(common[1].to_pylist())
    plain = sum(len(x) for b in NG._block_pieces([lines], ns) for x in b.column("pieces").to_pylist())
    for dense_bytes in (96 << 20, 1):
        monkeypatch.setattr(NG, "DENSE_BYTES", dense_bytes)
        dense = pa.Table.from_batches(list(NG._dense(NG._block_pieces([lines], ns, common))))
        assert dense.nbytes < (0.4 if dense_bytes > 1 else 0.5) * plain, (dense.nbytes, plain)
        assert dense_bytes == 1 or dense.num_rows == 64 * 3     # a row per bucket and kind of piece
        got = pa.Table.from_batches(NG._bucket_counts(NG._loose(dense.sort_by("bucket").to_batches(max_chunksize=50)), ns, common))
        want = collections.Counter((n, " ".join(w[i:i + n])) for w in (s.split(" ") for s in sentences) for n in ns for i in range(len(w) - n + 1))
        assert {(r["n"], r["ngram"]): r["cnt"] for r in got.to_pylist()} == want and got.num_rows == len(want)
    assert [len(x) for x in NG._common_words([])] == [0, 0]


def test_ngram_counts_of_odd_sentences(spark):
    df = spark.createDataFrame([("",), (None,), ("a_b c",), ("\u00e9\nx\U0001f600y  z",), ("A b",)], "s string")
    got = {(r.n, r.ngram): r.cnt for r in NG.ngram_counts(df, (1, 3), "s").collect()}
    assert got == {(1, ""): 6, (1, "a"): 1, (1, "b"): 2, (1, "c"): 1, (1, "x"): 1, (1, "y"): 1, (1, "z"): 1,
                   (3, "a b c"): 1, (3, "  x"): 1, (3, " x y"): 1, (3, "x y "): 1, (3, "y  z"): 1, (3, "  b"): 1}
    rows = NG.explode_ngrams(df, (1, 3), "s").groupBy("n", "ngram").count().collect()
    assert got == {(r.n, r.ngram): r["count"] for r in rows}
    plan = NG.ngram_counts(df, (1, 3), "s")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan, plan     # no row per position and n
