"""Compression bands, mixing, packing, language-model scores."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import zstandard

from bigraph.llm import compression_bands, lm_interpolation, mixing, packing
from bigraph.llm.queries import QUERIES, SQL, tokenizer_path

from . import brute
from .conftest import pairs

CHUNK = compression_bands.CHUNK


def base_of(text):
    text = text or ""
    w = brute.WORD.findall(text)
    k = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if k[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if brute.WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


def test_base_counts(documents, odd):
    for df in (documents, odd):
        want = Counter((d, *base_of(t)) for d, t in pairs(df))
        rows = compression_bands.compression_verdicts(df).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                       for r in rows) == want
        assert not any(r.kept for r in rows if r.base_failed)


def plain_limits(sized, spread, prior):
    """Limits from a list of ``(bytes, ratio)``: sorted ratios of the length
    bands, those with under 100 texts together with the next shorter ones."""
    bands = defaultdict(list)
    for size, ratio in sized:
        bands[math.floor(math.log2(size) * 4)].append((math.floor(ratio * 1000 + 0.5), size))
    groups, open_ = [], []
    for band in sorted(bands, reverse=True):
        open_.append(band)
        if sum(len(bands[b]) for b in open_) >= 100:
            groups.append(open_)
            open_ = []
    groups[-1].extend(open_)
    out = []
    for group in reversed(groups):
        values = sorted(v for b in group for v, _ in bands[b])
        lengths = sorted(b for b in group for _ in bands[b])
        n = len(values)
        q1, q3 = values[math.ceil(n / 4) - 1] / 1000, values[math.ceil(3 * n / 4) - 1] / 1000
        typical = 2 ** ((lengths[math.ceil(n / 2) - 1] + 0.5) / 4)
        lo, hi = next((lo, hi) for upto, lo, hi in prior if typical < upto)
        share, apart = n * n / (n * n + 40 * 40), max(q3 - q1, 0.001)
        out.append((2 ** ((max(group) + 1) / 4), share * (q1 - spread[0] * apart) + (1 - share) * lo,
                    share * (q3 + spread[1] * apart) + (1 - share) * hi))
    return out[:-1] + [(math.inf, *out[-1][1:])]


def test_verdicts_equal_a_plain_statement(spark):
    """Learned limits and verdicts of a whole table, document by document."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    press = zstandard.ZstdCompressor(level=3).compress
    texts = {}
    for d, t in pairs(docs):
        raw = (t or "").encode()
        parts = [(len(p), len(press(p)) / len(p)) for p in (raw[i:i + 2048] for i in range(0, len(raw), 2048))]
        texts[d] = (base_of(t)[-1], len(raw), len(press(raw)) / max(1, len(raw)), parts)
    passed = [x for x in texts.values() if not x[0]]
    whole = plain_limits([(n, r) for _, n, r, _ in passed], (2.5, 5.0), compression_bands.BANDS)
    part = plain_limits([p for x in passed for p in x[3]], (3.0, 6.0), compression_bands.CHUNK_BANDS)

    def inside(size, ratio, limits):
        return next(lo <= ratio <= hi for upto, lo, hi in limits if size < upto)

    want = {d: not failed and inside(n, r, whole) and sum(not inside(*p, part) for p in parts) <= 0.2 * len(parts)
            for d, (failed, n, r, parts) in texts.items()}
    got = {r.doc_id: r.kept for r in compression_bands.compression_verdicts(docs).collect()}
    assert got == want
    assert any(not k and not texts[d][0] for d, k in got.items())        # the limits reject some


def test_bands(spark):
    """Repetition that five-word windows miss, and random characters, are
    rejected; plain text is kept."""
    r = np.random.default_rng(1)
    plain = " ".join("".join(r.choice(list("etaoinshrdlu"), r.integers(2, 9))) for _ in range(900))
    noise = " ".join("".join(chr(c) for c in r.integers(33, 0x2FF, 30)) for _ in range(200))
    same = " ".join("a" * (3000 + i) for i in range(12))
    df = spark.createDataFrame([(1, plain), (2, noise), (3, same)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in compression_bands.compression_verdicts(df).collect()}
    assert got[1].kept and got[2].reason == "incompressible" and got[3].reason == "repetitive"


def test_bands_are_learned(spark):
    """Junk that the fixed limits pass, but whose ratio lies apart from those
    of texts of its length, is rejected, also in a text's short last chunk."""
    r = np.random.default_rng(2)
    words = ["".join(r.choice(list("etaoinshrdlu"), r.integers(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(r.choice(words, n))
    junk = lambda n: " ".join(f"{k % 2}{k % 3}{k % 5} {r.integers(0, 9)}" for k in range(n))
    rows = [(i, text(r.integers(300, 700))) for i in range(600)] + [(1000 + i, junk(500)) for i in range(20)]
    tail = [(2000 + i, text(900)[:CHUNK] + junk(170)) for i in range(5)]
    got = {x.doc_id: x for x in compression_bands.compression_verdicts(
        spark.createDataFrame(rows + tail, "doc_id bigint, text string")).collect()}
    assert np.mean([got[i].kept for i in range(600)]) > 0.97
    assert not any(x.kept for i, x in got.items() if 1000 <= i < 2000)
    for i, t in rows[600:]:
        lo, hi = compression_bands._band(len(t), compression_bands.BANDS)
        assert got[i].base_failed or lo <= got[i].ratio <= hi
    assert all(got[i].bad_chunks == 0.5 for i, _ in tail)


def test_learned_limits():
    length, bins, n = np.array([40, 40, 40, 44, 60]), np.array([500, 510, 520, 470, 100]), np.array([50, 100, 50, 200, 3])
    learn = lambda **k: compression_bands.learn_bands(length, bins, n, (2.0, 3.0), ((float("inf"), 0.2, 0.9),), **k)
    bands = learn(weight=0)
    assert len(bands) == 2 and compression_bands._band(1 << 30, bands) == compression_bands._band(2200, bands)
    assert np.allclose(compression_bands._band(1100, bands), (0.50 - 0.02, 0.51 + 0.03))
    # The prior weighs as much as so many texts, and alone where there are none.
    assert np.allclose(compression_bands._band(1100, learn(weight=200)), ((0.48 + 0.2) / 2, (0.54 + 0.9) / 2))
    empty = np.zeros(0, np.int64)
    assert compression_bands.learn_bands(empty, empty, empty, (2.0, 3.0), "prior") == "prior"
    assert len(learn(least=1000)) == 1


def test_limits_do_not_jump_with_the_table(spark):
    """Tables of 99 and 101 texts have nearly the same limits."""
    r = np.random.default_rng(3)
    bins = r.integers(480, 520, 101)
    one = lambda k: compression_bands.learn_bands(
        np.full(k, 40), bins[:k], np.ones(k, np.int64), (2.0, 3.0), compression_bands.BANDS)
    (a,), (b,) = one(99), one(101)
    assert max(abs(x - y) for x, y in zip(a[1:], b[1:])) < 0.02


def test_mixing_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = sorted(tuple(r) for r in QUERIES["op3_mixing"](spark, sf).collect())
    assert got == sorted(con.execute(SQL["op3_mixing"]).fetchall())


def fill(sizes, weights=(5, 2, 1), repeat=3):
    """Targets by capping and resharing until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > repeat * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: repeat * sizes[s] for s in over})


def test_mixing_targets_and_copies(spark, odd, none):
    rows = [(i, "w " * (1 + i % 7), None, s) for i, s in enumerate(
        ["a"] * 300 + ["b"] * 3 + ["é"] * 20 + [None] * 40 + ["z"] * 5 + ["B"] * 100)]
    df = spark.createDataFrame([(d, t, s) for d, t, _, s in rows], "doc_id bigint, text string, source string")
    sizes = defaultdict(int)
    for d, t, _, s in rows:
        sizes[s] += len(t.split())
    want = fill(sizes)
    got = mixing.mixed(df).collect()
    taken = defaultdict(int)
    for r in got:
        assert abs(r["__mix_target"] - want[r.source]) < 1e-6 and r["__mix_source_size"] == sizes[r.source]
        assert 0 <= r["__mix_copies"] <= 3
        taken[r.source] += r["__mix_copies"] * r["__mix_size"]
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.15 * sum(sizes.values())
    out = mixing.emit(df)
    assert out.columns == df.columns and out.count() == sum(r["__mix_copies"] for r in got)
    assert mixing.mixed(odd).count() == odd.count() and mixing.emit(odd).columns == odd.columns
    assert mixing.emit(none).collect() == []


def check_pieces(rows, texts, window):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for t in texts:
        want[np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()] += 1
    place = sorted((r.sequence_id * window + r.offset, r) for r in rows)
    at, parts, whole = 0, [], Counter()
    for where, r in place:
        assert where == at and r.offset + r.length <= window and len(r.ids) == 4 * r.length
        parts.append(bytes(r.ids))
        assert r.start == sum(map(len, parts[:-1])) // 4
        at += r.length
        if r.start + r.length == r.doc_tokens:
            whole[b"".join(parts)] += 1
            parts = []
    assert whole == want and not parts


@pytest.mark.parametrize("window", [2048, 16])
def test_packing_round_trip(documents, odd, none, window):
    for df in (documents, odd):
        rows = packing.pack(df, tokenizer_path(), window).collect()
        check_pieces(rows, [t for _, t in pairs(df)], window)
    assert packing.pack(none, tokenizer_path()).collect() == []


def test_units_equal_whole_texts():
    """Odd white space, specials and scripts: by units as by the tokenizer."""
    enc = packing.Encoder(tokenizer_path())
    assert enc.split
    for t in ("a  b", " a b ", "\n\na\n", "a \n b", "x<|endoftext|> y", "don't we'll I'M", "12 3a b4.", "é ñ, ß.", "a b",
              "a  b", "漢字 かな", "…... ,,,", "tab\there", "a.\nb,\nc", "é é. x", "²³ ½.", "\U0001f600 \U0001f600."):
        assert enc.encode(t) == enc.ids(t), t


def test_sequences(documents):
    pieces = packing.pack(documents.limit(20), tokenizer_path(), 64)
    seqs = packing.sequences(pieces, pad_id=9).collect()
    total = pieces.agg({"length": "sum"}).first()[0]
    rest = total % 64
    last = 64 if not rest or rest & (rest - 1) else rest
    assert sorted(len(s.ids) for s in seqs) == sorted([64] * (len(seqs) - 1) + [last])


@pytest.mark.parametrize("order", [2, 3])
def test_lm_base_and_model(documents, order):
    rows = lm_interpolation.interpolated_scores(documents, order=order).collect()
    want = brute.lm_base(pairs(documents))
    for r in rows:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4] and abs(r.base_score - w[4]) < 1e-6
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def mixture(rows, order, weights, folds=7, held=2):
    """``{id: score}`` with every count taken from the text, given weights by
    the bit length of the longest context's count."""
    import math
    import zlib
    from collections import Counter

    toks = {d: ["<s>"] + brute.WORD.findall((t or "").translate(brute.LOWER)) + ["</s>"] for d, t in rows}
    train = [w for d, w in toks.items() if zlib.crc32(str(d).encode()) % folds != held]
    grams = Counter(tuple(w[i:i + k]) for w in train for k in range(1, order + 1) for i in range(len(w) - k + 1)
                    if k > 1 or i > 0)
    n, v = sum(c for g, c in grams.items() if len(g) == 1), sum(len(g) == 1 for g in grams)
    grams[("<s>",)] = len(train)

    def probability(history, word):
        p, context = [1 / (v + 1), grams[(word,)] / n], n
        for k in range(2, order + 1):
            h = tuple(history[-(k - 1):])
            context = grams[h] if len(h) == k - 1 else 0
            p.append(grams[h + (word,)] / context if context else 0.0)
        return float(weights[min(context.bit_length(), 31)] @ p)

    scores = {d: sum(math.log10(probability(w[:i], w[i])) for i in range(1, len(w))) for d, w in toks.items()}
    starters = [w[1] for w in train if w[1] != "</s>"]
    return scores, probability, [g[0] for g in grams if len(g) == 1 and g[0] != "<s>"], starters


@pytest.mark.parametrize("order", [2, 3])
def test_lm_scores_equal_the_mixture_written_out(spark, documents, order):
    """All training documents count, tuning ones too; with any weights."""
    rng = np.random.default_rng(order)
    weights = rng.dirichlet(np.ones(order + 1), 32)
    sample = documents.select("doc_id", "text").where("length(text) < 4000")
    got = {r.doc_id: r.score for r in lm_interpolation._scores(
        sample, "doc_id", "text", order, 7, 2, 16, weights).collect()}
    want, probability, words, starters = mixture(pairs(sample), order, weights)
    assert got.keys() == want.keys() and max(abs(got[d] - want[d]) for d in want) < 1e-6
    # Continuations of a seen history of full length, one unseen word included, sum to one.
    for history in ([["<s>"]] if order == 2 else []) + [["<s>", w] for w in starters[:3]]:
        whole = sum(probability(history, w) for w in words) + probability(history, "\0")
        assert abs(whole - 1) < 1e-9


def test_lm_default_uses_trigrams(spark):
    """Two words before decide the third: the default order finds it, order 2
    cannot."""
    rows = [(i, " ".join(["a x c", "b x d"][(i + k) % 2] for k in range(20))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    score = lambda **k: sum(r.score for r in lm_interpolation.interpolated_scores(df, **k).collect())
    assert lm_interpolation.ORDER == 3 and score() > 0.8 * score(order=2)


def test_lm_weights():
    base = lm_interpolation.BINS + 1
    cells, n = np.array([(3 * base + 8) * base + 1, (3 * base + 12) * base + base - 1]), np.array([10.0, 5.0])
    w = lm_interpolation.learn_weights(cells, n, 2, 1e-3)
    assert np.allclose(w.sum(axis=1), 1) and (w > 0).all() and w[3, 2] > w[3, 0]


def test_lm_partition_of_empty_tuning_texts(spark):
    """A batch of nothing but empty texts, tuning ones among them."""
    import zlib

    tune = [d for d in range(20_000) if zlib.crc32(str(d).encode()) % 7 != 2 and zlib.crc32(str(d).encode()) // 7 % 16 == 0]
    rows = [(d, "") for d in tune[:5]] + [(d, None) for d in tune[5:8]]
    for more in ([], [(100_000 + i, "some words here") for i in range(40)]):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
        if more:
            df = df.union(spark.createDataFrame(more, "doc_id bigint, text string"))
        got = lm_interpolation.interpolated_scores(df).collect()
        assert len(got) == len(rows) + len(more)
        assert all(r.n_tokens == 1 for r in got if r.doc_id < 100_000)


def test_lm_odd_rows(odd, none):
    rows = lm_interpolation.interpolated_scores(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (3, 4, 5))
    assert lm_interpolation.interpolated_scores(none).collect() == []


def test_mixing_many_sources(spark):
    """A source per document and more: the shares against a plain statement
    of the rule, without a task that holds all sources."""
    n = 20_000
    df = spark.range(n).selectExpr("id AS doc_id", "concat('s', lpad(string(id div 2), 6, '0')) AS source",
                                   "repeat('w ', int(1 + (id * 7919) % 97)) AS text")
    rows = {r.source: r for r in mixing.source_targets(df).collect()}
    names = sorted(rows)
    assert len(names) == n // 2
    size = {s: rows[s].source_size for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(size.values())
    while True:
        rest, free = total - 3 * sum(size[s] for s in capped), sum(w for s, w in weight.items() if s not in capped)
        more = {s for s in names if 3 * size[s] * free <= weight[s] * rest}
        if more == capped:
            break
        capped = more
    assert capped and len(capped) < len(names)
    for s in names:
        want = 3.0 * size[s] if s in capped else weight[s] * rest / free
        assert abs(rows[s].target - want) < 1e-6
