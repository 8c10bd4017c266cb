"""Token counts and tokenizer alignment against plain library calls, whitening against exact integers."""

import hashlib
import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment, token_counts, tokenizing, whitening

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["<|endoftext|> a b <|startoftext|>x", "é x ́y", "a  b c\n d\te f" * 40, "日本語 テキスト " * 30, " lead  x y ", "가 ᅡᆨ", "a▁b",
       "</s><s><unk> x", "\x00\x1f \x85   nbsp\xa0x", "aaa aaaa aaaaa", "it's we'll I'D", "1 2 3 45 678", "😀 😀x", "x" * 5000, "word " * 3000]


def plain_counts(path, texts):
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(model.encode(t)) for t in texts]
    library = Tokenizer.from_file(path)
    return [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD, PIECE])
def test_counts_are_those_of_the_library(spark, table, texts, path):
    rows = token_counts.count(table, path, limit=100).orderBy("doc_id").collect()
    plain = [t or "" for t in texts]
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows] == [
        (k, len(t.encode()), n, n > 100) for k, (t, n) in enumerate(zip(plain, plain_counts(path, plain), strict=True))]


@pytest.mark.parametrize("path", [BYTE, WORD, PIECE])
@pytest.mark.parametrize("plain", [False, True])
def test_splits_change_no_token(monkeypatch, texts, path, plain):
    monkeypatch.setattr(tokenizing, "KEEP", 50)  # what is remembered is dropped now and then
    monkeypatch.setattr(tokenizing, "BATCH_BYTES", 500)
    words = tokenizing.Vocabulary(path, plain)
    every = [t or "" for t in texts] + ODD
    assert words.step is not None and max(len(words.stretches(t)) for t in every) > 1000
    want = list(words.encoded(every))
    for k, t in enumerate(every):
        assert [i for ids in words.encoded(words.stretches(t)) for i in ids] == want[k]
    for k in range(0, len(every), 7):
        assert words.counts(every[k:k + 7]).tolist() == [len(x) for x in want[k:k + 7]]
    assert 0 < len(words.known) and all(len(k) <= tokenizing.KEPT_CHARS for k in words.known)
    if not plain:
        assert [len(x) for x in want] == plain_counts(path, every)


def test_unknown_kinds_get_whole_texts(tmp_path):
    library = Tokenizer.from_file(BYTE)
    library.add_tokens(["two words"])
    library.save(str(tmp_path / "own.json"))
    words = tokenizing.Vocabulary(str(tmp_path / "own.json"))
    assert words.step is None and words.stretches("one two words three") == ["one two words three"]


def test_counts_of_nulls_repeats_and_empty_tables(spark, empty):
    rows = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, None), (2, "")], "doc_id long, text string")
    got = sorted(map(tuple, token_counts.count(rows, WORD).collect()), key=str)
    assert got == sorted([(1, 7, 2, False)] * 2 + [(None, 0, 0, False), (2, 0, 0, False)], key=str)
    assert token_counts.count(empty, WORD).collect() == []


def plain_alignment(texts):
    """Token by token: groups, links and the documents of each pair."""
    a_side, b_side = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a_side.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(sorted({*range(256)} - {*shown}))}
    out, holds = [], Counter()
    for text in texts:
        links, groups = [], []
        a = [(k, bytes(letters[c] for c in a_side.id_to_token(k))) for k in a_side.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(k, bytes([int(b_side.id_to_piece(k)[3:5], 16)]) if b_side.is_byte(k) else b_side.id_to_piece(k).replace("▁", " ").encode())
             for k in b_side.encode(text or "")]
        if text and b"".join(t for _, t in a) == b"".join(t for _, t in b) == b" " + text.encode():
            i = j = at_a = at_b = 0
            one, two = [], []
            while i < len(a) or j < len(b):
                if at_a <= at_b:
                    one.append((a[i][0], at_a, at_a + len(a[i][1])))
                    at_a, i = one[-1][2], i + 1
                else:
                    two.append((b[j][0], at_b, at_b + len(b[j][1])))
                    at_b, j = two[-1][2], j + 1
                if at_a == at_b:
                    links += [(x, y) for x, s, e in one for y, u, v in two if s < v and u < e]
                    groups.append(",".join(str(x[0]) for x in one) + "|" + ",".join(str(y[0]) for y in two))
                    one, two = [], []
        else:
            a = b = []
        holds.update(set(links))
        out.append((len(a), len(b), len(groups), links, ";".join(groups)))
    top = defaultdict(int)
    for (x, _), n in holds.items():
        top[x] = max(top[x], n)
    return [(n_a, n_b, n_groups, len(links), sum(holds[p] == top[p[0]] for p in links), sum(holds[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if text else "") for n_a, n_b, n_groups, links, text in out]


@pytest.mark.parametrize("head", [0, 40, 1 << 18])
def test_alignment_against_a_plain_version(spark, texts, head):
    every = texts + ODD
    rows = spark.createDataFrame([(k, t, "x", k) for k, t in enumerate(every)], "doc_id long, text string, codes string, row long").repartition(3)
    got = alignment.compare(rows, BYTE, PIECE, head=head).orderBy("doc_id").collect()
    want = plain_alignment(every)
    assert [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got] == want
    assert sum(w[2] < w[0] for w in want) > 20  # groups of several tokens


def test_alignment_takes_a_pair_linked_both_ways_once(spark):
    """A pair of equal bytes may be a group of its own and overlap inside another: one document either way."""
    both = alignment.aligner(BYTE, PIECE)
    found = both.align(["aaa aa aaaa aaaaa a", "aa", "aaaaaaa aa aaa"])
    alike = found["codes"] < both.n_a
    assert alike.any() and (~alike).any()
    bounds = found["starts"]
    assert all(len(set(found["codes"][x:y].tolist())) == y - x for x, y in zip(bounds[:-1], bounds[1:], strict=True))
    n_a, links = found["n_a"].tolist(), found["n_links"].tolist()
    assert links == [found["times"][x:y].sum() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
    assert links == [a + b - g for a, b, g in zip(n_a, found["n_b"].tolist(), found["n_groups"].tolist(), strict=True)]


def test_alignment_counts_in_small_steps(spark, texts):
    """What a task passes on before it is full adds up to the same counts."""
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = alignment.aligned(rows, BYTE, PIECE, groups=True).persist()
    n_a = alignment.aligner(BYTE, PIECE).n_a
    small, large = (sorted(map(tuple, alignment.pair_counts(found, n_a, held).collect())) for held in (5, 1 << 20))
    assert small == large and len(large) > 100
    assert found.where("(n_a > 0) <> (groups <> '')").isEmpty()
    found.unpersist()


def test_alignment_of_nulls_repeats_and_empty_tables(spark, empty):
    rows = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, None), (None, "a▁b"), (3, "")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_a, r.n_links, r.count_sum) for r in alignment.compare(rows, BYTE, PIECE).collect())
    assert got == [(0, 0, 0, 0), (0, 0, 0, 0), (1, 2, 2, 4), (1, 2, 2, 4), (3, 0, 0, 0)]
    assert alignment.compare(empty, BYTE, PIECE).collect() == []


@pytest.mark.parametrize("kind", ["small", "wide", "negative", "one"])
def test_scatter_is_exact(kind):
    rng = np.random.default_rng(3)
    x = {"small": rng.integers(999_900, 1_000_100, (200, 7)), "wide": rng.integers(-2 ** 60, 2 ** 60, (70, 3)),
         "negative": rng.integers(-50, 0, (64, 5)), "one": np.full((1, 4), 9)}[kind]
    exact = x.astype(object)
    assert (whitening.scatter(x) == exact.T @ exact).all()


def plain_whitening(rows):
    """Exact sums with Python integers; eigenvectors of the covariance."""
    kept = [(k, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for k, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted(set(x for _, x in kept))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    cov = np.array([[float(Fraction(n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j], n * n)) for j in range(d)] for i in range(d)])
    value, vector = np.linalg.eigh(cov)
    return kept, n, sums, cov, value[::-1], vector[:, ::-1]


def test_whitening_against_exact_integers(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 1, (150, 20)) * np.linspace(0.1, 2, 20)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(base)]
    rows += [(200 + k, rows[k % 3][1]) for k in range(40)] + [(300, None), (301, []), (302, [None] + [0.5] * 19),
             (303, [math.nan] * 20), (304, [math.inf] + [0.0] * 19), (None, rows[5][1]), (305, [0.5] * 3), (306, [1e30] * 20)]
    df = spark.createDataFrame([(k, v, "n", 1) for k, v in rows], "vec_id long, embedding array<float>, n string, x int").repartition(3)
    got = whitening.whiten(df).collect()
    want = [r for r in rows if r[0] not in (305, 306)]
    kept, n, sums, cov, value, vector = plain_whitening(want)
    assert n == 150 and len(got) == 16 * len(kept)
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append(r)
    assert {k: len(v) for k, v in by.items()} == {k: 16 * c for k, c in Counter(k for k, _ in kept).items()}
    sign = {}
    for key, x in kept:
        centred = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)])
        for r in by[key]:
            e = value[r.component - 1]
            plain = centred @ vector[:, r.component - 1] / math.sqrt(e)
            sign.setdefault(r.component, math.copysign(1, r.whitened * plain))
            assert r.whitened == pytest.approx(sign[r.component] * plain, abs=1e-9)
            assert int(r.deviation) == sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
            assert r.explained == pytest.approx(e / np.trace(cov), rel=1e-12) and r.n == n and r.identity_error < 1e-9


def test_whitening_of_few_dimensions_flat_directions_and_empty_tables(spark):
    def run(rows):
        return sorted(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect(), key=lambda r: (r.vec_id, r.component))

    flat = run([(k, [k / 64, 2 * k / 64, 0.25]) for k in range(10)])
    assert [r.component for r in flat[:3]] == [1, 2, 3] and len(flat) == 30
    assert flat[0].explained == pytest.approx(1) and all(r.whitened is None and r.explained == 0 for r in flat if r.component > 1)
    one = run([(7, [0.5, 0.5])] * 4)
    assert len(one) == 8 and all(r.whitened is None and r.n == 1 and r.deviation == 0 for r in one)
    assert run([]) == [] and run([(1, None)]) == []


def test_whitening_keeps_large_sums_exact(spark):
    rows = [(k, [float(k) * 2 ** 30, -float(k) * 2 ** 40, 0.5 * (k % 2)]) for k in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("component = 1").collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(r[k] for r in x) for k in range(3)]
    for r in got:
        assert int(r.deviation) == sum((50 * c - s) ** 2 for c, s in zip(x[r.vec_id], sums, strict=True))


def test_deviations_in_limbs_are_exact():
    rng = np.random.default_rng(6)
    x = rng.integers(2 ** 52, 2 ** 54, (30, 6))
    exact = x.astype(object)
    model = whitening.Whitening(30, exact.sum(axis=0).tolist(), exact.T @ exact)
    assert model.apart(x).dtype != object
    assert model.deviations(x) == ((30 * exact - exact.sum(axis=0)) ** 2).sum(axis=1).tolist()
