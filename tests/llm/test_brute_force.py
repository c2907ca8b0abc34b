"""The operators against brute force on small fixtures and the small test tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from quarry.llm import bwt, language, minhash, multi_index, packing, quality_model, queries, shingles, substrings
from quarry.llm.common import held_out, row_blocks
from quarry.sources.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()}


def brute_prefixes(text, bound):
    """Suffix order with every 0 a symbol of its own, and where neighbours share fewer than bound symbols."""
    own = [tuple((int(x), 0) if x else (0, j) for j, x in enumerate(text[i:], i)) for i in range(len(text))]
    order = sorted(range(len(text)), key=own.__getitem__)
    cut = [True]
    for a, b in zip(order, order[1:], strict=False):
        k = 0
        while k < min(len(own[a]), len(own[b])) and own[a][k] == own[b][k]:
            k += 1
        cut.append(k < bound)
    return order, cut


def test_interval_expansion():
    rng = random.Random(3)
    for _ in range(60):
        base = bytes(rng.choice(b"ab\x00\xff") for _ in range(60))
        strings = list(dict.fromkeys(base[(a := rng.randint(0, 40)):a + rng.randint(0, 40)] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12)))
                                     for _ in range(rng.randint(1, 6))))
        text, _ = bwt.concatenated(strings)
        for bound in (8, 11, 20):
            order, cut = bwt.bounded_prefixes(text, bound)
            want = brute_prefixes(text, bound)
            assert order.tolist() == want[0] and cut.tolist() == want[1]


def brute_repeats(rows, length):
    """(n_bytes, n_removed, n_spans, digest) by listing every window's least id."""
    least = {}
    for i, t in rows:
        for k in range(len(t) - length + 1):
            least[t[k:k + length]] = min(i, least.get(t[k:k + length], i))
    out = Counter()
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if least[t[k:k + length]] < i:
                gone[k:k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out[i, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()] += 1
    return out


def test_repeats(spark, texts):
    got = queries.op3_repeats(spark, SF).collect()
    assert Counter(map(tuple, got)) == brute_repeats([(i, (t or "").encode()) for i, t in texts.items()], 50)


@pytest.mark.parametrize(("block", "hot"), [(2000, 3), (300, 10 ** 9), (1 << 20, 2)])
def test_repeats_small_alphabet(spark, block, hot):
    """Overlapping, self-repeating and period texts; windows dealt one by one as well."""
    rng = random.Random(block)
    pool = ["".join(rng.choice("ab ") for _ in range(rng.randint(40, 160))) for _ in range(6)] + ["ab" * 70, "x" * 130]
    rows = [(rng.randint(0, 40), "".join(rng.choice(pool)[rng.randint(0, 30):] for _ in range(rng.randint(1, 4)))) for _ in range(60)]
    done = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), block=block, hot=hot).collect()
    got = Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in done)
    assert got == brute_repeats([(i, t.encode()) for i, t in rows], 50)


def test_segments_cover_long_texts(monkeypatch):
    """Anchors of one long text do not depend on where segments are cut."""
    rng = random.Random(1)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(5000))
    whole = set(substrings.Anchors([text]).keys()[0].tolist())
    monkeypatch.setattr(substrings, "SEGMENT", 700)
    assert set(substrings.Anchors([text]).keys()[0].tolist()) == whole


def sets_of(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in sets}


def test_near_duplicates(spark, texts):
    sets = {i: sets_of(t) for i, t in texts.items()}
    comps = brute_components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op7_minhash(spark, SF).collect()}
    assert got == {i: (len(sets[i]), comps[i], comps[i] == i) for i in sets}


@pytest.mark.parametrize("small", [256, 4])
def test_near_duplicates_of_a_large_cluster(spark, monkeypatch, small):
    """Chains and variants of a few texts; large clusters go by leaders and chunks."""
    for name, value in (("SMALL", small), ("LEADERS", 1), ("CHUNK_U", 5), ("CHUNK_V", 7)):
        monkeypatch.setattr(minhash, name, value)
    rng = random.Random(5)
    rows = []
    for base in range(3):
        words = [f"w{base}_{k}" for k in range(120)]
        for k in range(30):
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"v{base}_{k}_{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_components({i: sets_of(t) for i, t in rows})


def test_large_clusters_broadcast_nothing(spark, monkeypatch):
    """Leaders and main components grow with the corpus, so they are joined by a merge."""
    for name, value in (("SMALL", 4), ("LEADERS", 2), ("CHUNK_U", 5), ("CHUNK_V", 7), ("MEMBER_ROWS", 0)):
        monkeypatch.setattr(minhash, name, value)
    monkeypatch.setattr(minhash.F, "broadcast", lambda df: pytest.fail("broadcast"))
    rng = random.Random(7)
    rows = []
    for base in range(2):
        words = [f"w{base}_{k}" for k in range(120)]
        for k in range(40):
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"v{base}_{k}_{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_components({i: sets_of(t) for i, t in rows})


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    error = []
    for _ in range(60):
        common, rest = rng.integers(0, 2 ** 53, 300, dtype=np.uint64), rng.integers(0, 2 ** 53, 100, dtype=np.uint64)
        a, b = np.concatenate([common, rest[:50]]), np.concatenate([common, rest[50:]])
        sig = minhash.superminhash(np.concatenate([a, b]), np.array([350, 350]))
        error.append((sig[0] == sig[1]).mean() - 300 / 400)
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.045   # 128 slots
    one = minhash.superminhash(np.arange(3, dtype=np.uint64), np.array([3]))[0]
    assert len(np.unique(one)) == 128 and (one >> np.uint64(32)).max() < 128   # a small set fills every slot


def test_shingles_are_sets_of_words(texts):
    some = [t.encode() for t in list(texts.values())[:150]] + [b"", b" ", b"A b", b"a B", b"a b c d e a b c d e a"]
    for part in row_blocks(some, 20_000):
        elements, sizes = shingles.shingle_sets(some[part])
        assert sizes.tolist() == [len(sets_of(t.decode())) for t in some[part]]
    elements, sizes = shingles.shingle_sets([b"A b", b"a\tB\n"])
    assert elements[0] == elements[1]


def test_packing(spark, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = queries.op8_packing(spark, SF).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t in texts.items():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    pad = total = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        total += at
        pad += 0 if at & (at - 1) == 0 else 4096 - at
    assert pad <= 0.02 * total


def test_word_encoder_equals_the_library(texts):
    from tokenizers import Tokenizer
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        encoder = packing.WordEncoder(f.read())
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    odd = ["ÑÇ ªº x² Ǆ ŉ ſ é Dž ß. don't! a_b. ere_., é*** İ", "Σίσυφος ΣΑΣ ok. Ǆ İ", "a..b c.. I'LL <|endoftext|> x<|END <|EndOfText|>",
           "\t x　y \x85 z", "\n", "", " \n .", "12.5 a-b (c).", "Ġ ġ Ā Ġ"]
    some = [*odd, *(t for t in list(texts.values())[:60])]
    ids, lens = encoder([t.encode() for t in some])
    for t, own in zip(some, np.split(ids, np.cumsum(lens)[:-1]), strict=True):
        assert own.tolist() == [*tok.encode(t, add_special_tokens=False).ids, 2], t


def test_cuts_are_optimal():
    rng = random.Random(4)
    for _ in range(30):
        pos = np.array([0, *sorted(rng.sample(range(1, 120), 14))])
        cost = np.array([0, *(rng.choice([0, 3, 9]) for _ in pos[1:])])
        if np.diff(pos).max() > 32:
            continue
        best = [0] + [10 ** 9] * (len(pos) - 1)
        for j in range(1, len(pos)):
            best[j] = min(best[i] + 32 - int(pos[j] - pos[i]) + int(cost[j]) for i in range(j) if pos[j] - pos[i] <= 32)
        ends = packing.cut(pos, cost, 32)
        paid = sum(32 - (e - s) for s, e in zip([0, *ends], ends[:-1], strict=False)) + sum(int(cost[pos.tolist().index(e)]) for e in ends[:-1])
        assert paid == min(b for b, p in zip(best[:-1], pos, strict=False) if pos[-1] - p <= 32)


def test_vectors_against_all_pairs(spark, monkeypatch):
    """Groups of near copies, one of them larger than a chunk of the index."""
    monkeypatch.setattr(multi_index, "CHUNK", 64)
    rng = np.random.default_rng(8)
    rows, x = [], []
    for label in range(3):
        for group in range(12):
            centre = rng.standard_normal(32)
            for _ in range(200 if (label, group) == (0, 0) else 15):
                v = (centre + rng.standard_normal(32) * rng.choice([0.1, 0.28])).astype(np.float32)
                rows.append((len(rows), v.tolist(), label))
                x.append(v.astype(np.float64))
    x = multi_index.unit(np.array(x))
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    got = {r.vec_id: r for r in multi_index.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    n = np.array([got[i].n_links for i in range(len(rows))])
    assert (n <= near.sum(1)).all() and n.sum() >= 0.98 * near.sum()


def test_equal_vectors_and_repeated_ids(spark):
    """Copies of a vector count as links of each other; an id with two vectors joins their components."""
    rng = np.random.default_rng(12)
    far = [rng.standard_normal(16).astype(np.float64) for _ in range(40)]
    rows = [(100 + i, v.tolist(), 0) for i, v in enumerate(far)]
    rows += [(200 + i, far[0].tolist(), 0) for i in range(300)] + [(600, (far[0] * 1.0001 + 0.001).tolist(), 0), (700, far[0].tolist(), 1)]
    rows += [(800, far[1].tolist(), 0), (800, far[2].tolist(), 0), (800, far[2].tolist(), 0)]
    got = {r.vec_id: tuple(r)[1:] for r in multi_index.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    assert all(got[i] == (301, 100, i == 100) for i in [100, 600, *range(200, 500)])
    assert got[700] == (0, 700, True) and got[800] == (2, 101, False)
    assert got[101] == (1, 101, True) and got[102] == (1, 101, False)
    assert all(got[i] == (0, i, True) for i in range(103, 140))


def test_products_follow_the_visited_cells():
    """A chunk multiplies a probe with the vectors of the cells it visits, no others."""
    import pyarrow as pa
    rng = np.random.default_rng(13)
    centres = rng.standard_normal((64, 32)) * 3
    x = multi_index.unit(centres[rng.integers(64, size=6000)] + rng.standard_normal((6000, 32))).astype(np.float32)
    grid = multi_index.Grid(multi_index.unit(x[:3000].astype(np.float64)), 12)
    y = multi_index.unit(x.astype(np.float64))
    cell, made = grid.cell(y), []
    for visits in (grid.visits, max(1, grid.visits // 2), 1):
        grid.visits = visits
        went = grid.visit_order(y)
        batch = pa.RecordBatch.from_arrays(
            [pa.array([i.to_bytes(16, "big") for i in range(6000)], pa.binary()), pa.array(range(6000), pa.int64()), pa.array([1] * 6000, pa.int64()),
             pa.array([r.tobytes() for r in x], pa.binary()), pa.array(cell.astype(np.int32)), pa.array([w.astype("<i4").tobytes() for w in went], pa.binary())],
            ["digest", "rep", "n", "x", "cell", "visits"])
        chunk = multi_index.Chunk(batch, "<f4", 0.93)
        counts = np.concatenate([chunk.compare(batch.slice(k, 1000))[0] for k in range(0, 6000, 1000)])
        held = np.bincount(cell, minlength=144)
        assert chunk.products == held[went].sum()
        made.append(chunk.products)
        met = (went[:, :, None] == cell).any(1) if visits == 1 else None
        if met is not None:
            near = (y @ y.T >= 0.93) & ~np.eye(6000, dtype=bool)
            back = np.zeros(6000, np.int64)
            order = np.argsort(cell, kind="stable")
            back[order] = chunk.back
            assert (counts + back == (near & (met | met.T)).sum(1)).all()
    assert made[0] > made[1] > made[2] and made[0] < 6000 * 6000


def test_visits_reach_the_target_on_unseen_vectors():
    """Pairs at the threshold among vectors that took no part in the fit, 64 codewords a half."""
    rng = np.random.default_rng(9)
    grid = multi_index.Grid(multi_index.unit(rng.standard_normal((multi_index.SAMPLE, 64))), 64)
    x = multi_index.unit(rng.standard_normal((4000, 64)))
    side = rng.standard_normal(x.shape)
    side = multi_index.unit(side - (side * x).sum(1, keepdims=True) * x)
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * side
    met = (grid.visit_order(x) == grid.cell(y)[:, None]).any(1) | (grid.visit_order(y) == grid.cell(x)[:, None]).any(1)
    assert met.mean() >= 0.998


def accuracy(rows):
    return sum(rows) / len(rows)


def test_language_on_held_out_texts(spark):
    truth = {r.doc_id: r.lang for r in read_table(spark, SF, "documents").collect()}
    got = queries.op6_language(spark, SF).collect()
    assert accuracy([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(truth)


def test_families_part_first(spark):
    docs = read_table(spark, SF, "documents")
    model = language.fit(docs.where(~held_out("doc_id")))
    assert model.families == ["germanic", "romance"] and [tuple(sorted((model.langs[a], model.langs[b]))) for _, a, b in model.pairs] == [("de", "en"), ("es", "fr")]


def test_quality_on_held_out_texts(spark):
    truth = {r.doc_id: r.quality for r in read_table(spark, "/root/testdata/sf0.01", "labels").collect()}
    got = [r for r in queries.op10_quality_model(spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in truth]
    assert accuracy([r.predicted == truth[r.doc_id] for r in got]) >= 0.95


def test_repetition_terms():
    x = quality_model.repetition([b"a a a a a a", b"a b c d e f g h", b"", b"x\nx\nx\n"])
    assert x[0, 0] > x[1, 0] == 0 and x[2, 3] > 0 and x[3, 2] > 0


def test_pages_of_the_table(spark):
    import html
    import re
    rows = read_table(spark, SF, "pages").collect()
    got = {r.page_id: r for r in queries.op9_html(spark, SF).collect()}
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", body)]
        want = "\n".join(x for x in lines if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)
