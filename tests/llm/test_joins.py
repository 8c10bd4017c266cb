"""Operators on pairs, repeats and trees against brute force, and the defined results of odd rows."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm import boosting, common, dom, embedding_dedup, html_extract, linking, ngram_join, queries, spot_signatures, suffix_dedup, windows
from tidemark.llm.suffix_array import common_prefixes, repeated, suffix_array


def plain_classes(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("links", [
    [], [(k, k + 1) for k in range(40)], [(k, 50) for k in range(40)], [(k, (7 * k) % 41) for k in range(41)], [(3, 3), (9, 4), (4, 9), (1, 4)]])
def test_classes(spark, links):
    got = {r.node: r.root for r in common.classes(spark.createDataFrame(links, "a long, b long")).collect()}
    want = plain_classes({x for e in links for x in e}, links)
    assert got == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in links)}


def word_sets(texts, words):
    out = {}
    for k, t in enumerate(texts):
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        out[k] = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    return out


def plain_join(texts, words, percent):
    sets = word_sets(texts, words)
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = plain_classes(sets, links)
    return {k: (len(sets[k]), root[k]) for k in sets}


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_ngram_join(table, texts, words, percent):
    got = ngram_join.join(table, words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_join(texts, words, percent) and len(got) == len(texts)


def test_ngram_join_of_a_tight_and_a_loose_group(spark):
    """A group all linked to one text, and one whose members mostly do not link: the pair-by-pair turn."""
    rnd = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base)]
    for _ in range(30):
        words = list(base)
        words[rnd.randrange(60)] = f"new{rnd.random()}"
        texts.append(" ".join(words))
    for _ in range(30):
        words = list(base)
        for k in rnd.sample(range(60), 4):
            words[k] = f"new{rnd.random()}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for percent in (90, 85, 70):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, 3, percent).collect()}
        assert got == plain_join(texts, 3, percent)


@pytest.mark.parametrize("number", range(5))
def test_tables_of_less_words_than_a_shingle(spark, number):
    text = " ".join(["hello", "world", "good", "day"][:number])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert len(ngram_join.shingles([text.encode()], 5)[0]) == (number > 0)
    assert [tuple(r) for r in ngram_join.join(docs, 5, 80).collect()] == [(1, int(number > 0), 1)]
    assert [r.text for r in ngram_join.one_per_class(docs, 5, 80).collect()] == [text]


def test_ngram_join_of_odd_rows(spark, empty):
    assert ngram_join.join(empty).collect() == []
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(1, long), (1, long), (None, long), (4, long + " x"), (5, None), (6, ""), (7, long)]
    got = sorted(map(tuple, ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()), key=str)
    assert got == sorted([(1, 28, 1), (1, 28, 1), (None, 28, None), (4, 29, 1), (5, 0, 5), (6, 0, 6), (7, 28, 1)], key=str)
    left = ngram_join.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 1, None, 5, 6], key=str)


def test_one_row_of_each_class_is_kept(spark):
    long = " ".join(f"w{k}" for k in range(30))
    other = " ".join(f"v{k}" for k in range(30))
    rows = [(2, long, 1), (2, long, 0), (None, long, 0), (None, long, 0), (4, long + " x", 0), (5, None, 0), (6, "", 0), (None, other, 0), (None, other, 0),
            (None, other + " x", 0), (7, "other words of an id", 0), (7, "quite different ones here", 0), (None, " ", 0), (1, other + " y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, turn long").repartition(3)
    left = ngram_join.one_per_class(docs, 3, 90)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted([
        (2, long, 0), (5, None, 0), (6, "", 0), (1, other + " y", 0), (7, "other words of an id", 0), (7, "quite different ones here", 0),
        (None, " ", 0)], key=str)
    nameless = ngram_join.one_per_class(docs.selectExpr("cast(null as long) doc_id", "text"), 3, 90)
    assert len([r for r in nameless.collect() if (r.text or "").startswith(("w0", "v0"))]) == 2


def test_spot_classes(table, texts, empty):
    prints = spot_signatures.fingerprints(table)
    sets = {r.doc_id: set(np.frombuffer(r.fingerprint, ">u4").tolist()) for r in prints.collect()}
    for percent in (80, 60):
        links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        got = {r.doc_id: r.component_id for r in spot_signatures.near_duplicates(prints, percent).collect()}
        assert got == plain_classes(sets, links)
    assert spot_signatures.near_duplicates(spot_signatures.fingerprints(empty)).collect() == []


def test_spot_classes_of_crowds_and_shared_ids(spark):
    """Crowded postings are compared as blocks with the result of all pairs; ids of several texts join their classes."""
    rnd = random.Random(5)
    words = [f"word{k}" for k in range(900)]
    base = " ".join(f"the {rnd.choice(words)} {rnd.choice(words)}" for _ in range(60)).split()
    rows = []
    for k in range(220):  # near copies, some linked with each other, most not
        own = list(base)
        for at in rnd.sample(range(len(own)), rnd.choice((0, 3, 12, 25))):
            own[at] = rnd.choice(words)
        rows.append((k, " ".join(own)))
    prints = spot_signatures.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).cache()
    sets = {r.doc_id: set(np.frombuffer(r.fingerprint, ">u4").tolist()) for r in prints.collect()}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = {r.doc_id: r.component_id for r in spot_signatures.near_duplicates(prints).collect()}
    assert got == plain_classes(sets, links)
    prints.unpersist()
    one, two, other = " ".join(base), " ".join(f"of {w}" for w in words[:80]), " ".join(f"is {w}" for w in words[100:180])
    rows = [(4, one), (9, one), (9, two), (2, two), (None, two), (7, other), (7, other), (5, None), (6, ""), (5, "")]
    got = spot_signatures.near_duplicates(spot_signatures.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(4, 2), (9, 2), (9, 2), (2, 2), (None, None), (7, 7), (7, 7), (5, 5), (6, 6), (5, 5)], key=str)


def test_edits_with_classes(spark, table, texts, empty):
    """The comparison with edits is the same with classes beside it, and the classes are those of the fingerprints alone."""
    rows = {r.doc_id: r for r in spot_signatures.with_classes(table).collect()}
    plain = {r.doc_id: r for r in spot_signatures.against_edits(table).collect()}
    classes = {r.doc_id: r.component_id for r in spot_signatures.near_duplicates(spot_signatures.fingerprints(table)).collect()}
    assert {k: r.component_id for k, r in rows.items()} == classes and any(k != c for k, c in classes.items())
    assert {k: tuple(r)[:-1] for k, r in rows.items()} == {k: tuple(r) for k, r in plain.items()}
    assert spot_signatures.with_classes(empty).collect() == []
    text = "the old house of the green river bank is not far and the tall trees are here"
    odd = [(3, text, 1), (8, text, 2), (8, text, 3), (None, text, 4), (None, None, 5), (11, "", 6), (12, None, 7), (1, text + " now", 8)]
    odd = spark.createDataFrame(odd, "doc_id int, text string, component_id int").repartition(3)
    got = sorted(((r.doc_id, r.n_chars, r.component_id) for r in spot_signatures.with_classes(odd).collect()), key=str)
    n = len(text)
    a, b = (set(x.tolist()) for x in spot_signatures.Spots()([text, text + " now"]))
    least = 1 if 100 * len(a & b) >= 80 * len(a | b) else 3
    assert got == sorted([(3, n, least), (8, n, least), (8, n, least), (None, n, None), (None, 0, None), (11, 0, 11), (12, 0, 12), (1, n + 4, 1)], key=str)


def test_suffix_array_and_prefixes():
    rnd = random.Random(3)
    for _ in range(150):
        body = bytes(rnd.randint(2, 1 + rnd.choice((1, 2, 3, 26))) for _ in range(rnd.randint(1, 200))) * rnd.choice((1, 1, 3))
        text = np.frombuffer(body + b"\0", np.uint8)
        order = sorted(range(len(text)), key=lambda i: bytes(text[i:]))
        assert suffix_array(text).tolist() == order
        before, shared = common_prefixes(text, np.array(order))
        for prior, at in itertools.pairwise(order):
            n = 0
            while text[prior + n] == text[at + n]:
                n += 1
            assert before[at] == prior and shared[at] == n


def test_suffix_array_of_long_runs_and_large_alphabets():
    for text in (np.full(5000, 7), np.arange(3000)[::-1] + 1, np.random.default_rng(0).integers(1, 900, 4000), np.tile(np.arange(1, 40), 90)):
        text = np.append(text, 0)
        raw = text.tolist()
        assert suffix_array(text).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


@pytest.mark.parametrize("odd", [b"", b"\xff\xfe"])
def test_repeated_stretches(odd):
    rnd = random.Random(8)
    for _ in range(60):
        length = rnd.choice((1, 3, 6))
        contents = list(dict.fromkeys(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 30))) + odd for _ in range(rnd.randint(1, 6))))
        often = np.array([rnd.choice((1, 1, 2)) for _ in contents])
        count = collections.Counter()
        for c, n in zip(contents, often.tolist(), strict=True):
            for i in range(len(c) - length + 1):
                count[c[i:i + length]] += n
        for c, spans in zip(contents, repeated(contents, often, length), strict=True):
            want = {j for i in range(len(c) - length + 1) if count[c[i:i + length]] > 1 for j in range(i, i + length)}
            assert {j for a, b in spans for j in range(a, b)} == want


def test_equal_windows_have_equal_keys():
    rnd = random.Random(6)
    texts = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 300))) for _ in range(20)] + [b"a" * 200, b"ab" * 100]
    texts += [t[10:90] for t in texts]
    seen = collections.defaultdict(set)
    for t in texts:
        key, _, start, end, _, again = windows.runs(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 20, 5)
        covered = []
        for k, a, b, more in zip(key.tolist(), start.tolist(), end.tolist(), again.tolist(), strict=True):
            inside = [t[i:i + 20] for i in range(a, b - 19)]
            covered += inside
            assert more or len(set(inside)) == len(inside)
            for w in inside:
                seen[w].add(k)
        assert covered == [t[i:i + 20] for i in range(len(t) - 19)]
    assert all(len(keys) == 1 for keys in seen.values())


def plain_repeats(texts, length):
    bodies = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = {}
    for k, b in enumerate(bodies):
        cut = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                cut[i:i + length] = b"\1" * length
        spans = sum(1 for i, c in enumerate(cut) if c and (not i or not cut[i - 1]))
        out[k] = (len(b), sum(cut), spans, bytes(x for x, c in zip(b, cut, strict=True) if not c))
    return out


@pytest.mark.parametrize(("length", "group"), [(400, 1 << 23), (60, 1 << 23), (60, 100), (7, 1 << 23)])
def test_suffix_dedup(table, texts, length, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup.spans, "__defaults__", ("doc_id", "text", length, group, "spans"))
    want = plain_repeats(texts, length)
    got = suffix_dedup.digests(table, length=length).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {k: (*v[:3], hashlib.sha256(v[3]).hexdigest()) for k, v in want.items()}
    assert len(got) == len(texts)


def test_repeated_passages_go_from_400_bytes_on(spark):
    rnd = random.Random(8)
    words = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=4)) for _ in range(n))
    rows, want = [], {}
    # over 50 words each: 349, 399, 400 and 699 bytes, between other bytes in either document
    for passage in (words(70), words(80), words(80) + "x", words(140)):
        for left, right in ("[]", "()"):
            before, after = words(120) + left, right + words(120)
            text, cut = before + passage + after, len(passage) >= 400
            rest = before + after if cut else text
            want[len(rows)] = (len(text), len(passage) if cut else 0, int(cut), hashlib.sha256(rest.encode()).hexdigest())
            rows.append((len(rows), text))
    for _ in range(4):  # nothing in them repeats
        text = words(300)
        want[len(rows)] = (len(text), 0, 0, hashlib.sha256(text.encode()).hexdigest())
        rows.append((len(rows), text))
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_rows_show_the_text_without_its_repeats(spark, tmp_path):
    rnd = random.Random(9)
    words = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n))
    rows, want = [(0, None), (1, ""), (2, words(200))], {0: "", 1: ""}
    want[2] = rows[2][1]
    passages = [words(60), words(90)]  # over 50 words and 400 bytes each
    for k, (left, right) in enumerate(("[]", "()", "{}"), 3):
        before, between, after = words(80) + left, right + words(80) + left, right + words(80)
        rows.append((k, before + passages[0] + between + passages[1] + after))
        want[k] = before + between + after
    # both start inside a character, the second byte of which is the same
    passage = words(70)
    rows += [(6, "x\u00e9" + passage + "y"), (7, "z\u0129" + passage + "w")]
    want |= {6: "xy", 7: "zw"}
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op4_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert got[6].n_removed == got[7].n_removed == len(passage) + 1 and got[6].kept_sha256 == hashlib.sha256(b"x\xc3y").hexdigest()
    for k in range(6):
        left = got[k].text.encode()
        assert got[k].kept_sha256 == hashlib.sha256(left).hexdigest() and got[k].n_bytes - got[k].n_removed == len(left)


def test_suffix_dedup_keeps_columns_and_rows(table, texts, empty):
    out = suffix_dedup.without_repeats(table, length=60)
    want = plain_repeats(texts, 60)
    assert out.columns == table.columns
    assert {r.doc_id: r.text for r in out.collect()} == {k: None if t is None else want[k][3].decode("utf-8", "ignore") for k, t in enumerate(texts)}
    assert suffix_dedup.digests(empty).collect() == []


def vectors(rnd, n, d):
    base = rnd.normal(size=(8, d))
    rows = base[rnd.integers(0, 8, n)] + rnd.normal(size=(n, d)) * rnd.choice([0.02, 0.1, 0.2, 1], size=(n, 1))
    rows[: n // 10] = rows[0]
    return rows.astype(np.float32).astype(float)


def test_quantised_products_never_lose_a_pair():
    rnd = np.random.default_rng(2)
    for d, threshold in ((4, 0.98), (64, 0.98), (64, 0.9), (1500, 0.95)):
        rows = vectors(rnd, 120, d)
        unit = rows / np.linalg.norm(rows, axis=1)[:, None]
        near = unit @ unit.T >= threshold
        a = embedding_dedup.quantise(rows)
        assert (embedding_dedup.possible(a, a, threshold) | ~near).all()
        if d == 64:
            assert embedding_dedup.possible(a, a, threshold).mean() < near.mean() + 0.05


@pytest.mark.parametrize("tile", [2048, 16])
def test_near_duplicate_vectors(spark, tile):
    rnd = np.random.default_rng(1)
    rows = [(int(k), v.tolist(), int(k % 3)) for k, v in enumerate(vectors(rnd, 150, 12))]
    bad = [None, [], [0.0] * 12, [float("nan")] * 12, [None] + [1.0] * 11, [float("inf")] * 12, [1.0] * 5, [1.0] * 5]
    rows += [(1000 + k, v, 0) for k, v in enumerate(bad)] + [(2000, rows[0][1], None), (2001, [-x for x in rows[0][1]], 0), (2002, [5 * x for x in rows[0][1]], 0)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    good = {k: (np.array(v, np.float32).astype(float), lab) for k, v, lab in rows
            if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a, b in itertools.combinations(good, 2) if good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0])
             and good[a][0] @ good[b][0] / np.sqrt((good[a][0] @ good[a][0]) * (good[b][0] @ good[b][0])) >= 0.98]
    ids = [r[0] for r in rows]
    root, number = plain_classes(ids, links), collections.Counter(x for e in links for x in e)
    got = embedding_dedup.near_duplicates(docs, tile=tile).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {k: (number[k], root[k], root[k] == k) for k in ids} and len(got) == len(ids)
    assert embedding_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_boosted_trees_learn_and_ignore_noise():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(4000, 6))
    y = ((x[:, 1] > 0.2) ^ (x[:, 4] > 0)).astype(float)
    trees = boosting.BoostedTrees(trees=30, depth=3).fit(x[:3000], y[:3000])
    assert ((trees.score(x[3000:]) > 0) == y[3000:]).mean() > 0.97
    noise = boosting.BoostedTrees(trees=10, depth=3).fit(x[:3000], rnd.integers(0, 2, 3000).astype(float))
    assert abs(((noise.score(x[3000:]) > 0) == y[3000:]).mean() - 0.5) < 0.1


@pytest.fixture(scope="module")
def trees():
    return html_extract.fitted(250)


def test_main_text_of_held_out_pages(trees):
    pages = [html_extract.made_page(seed) for seed in range(50_000, 50_150)]
    got = html_extract.main_texts([p.replace(dom.MARK, "") for p, _ in pages], trees)
    share = []
    for (_, want), text in zip(pages, got, strict=True):
        a, b = want.split(), text.split()
        share.append(2 * sum((collections.Counter(a) & collections.Counter(b)).values()) / max(1, len(a) + len(b)))
    assert np.mean(share) > 0.97 and np.mean([w == g for (_, w), g in zip(pages, got, strict=True)]) > 0.85


def test_decoding_is_the_best_consistent_choice():
    rnd = random.Random(1)
    for _ in range(200):
        n = rnd.randint(2, 9)
        parent = np.array([-1, *(rnd.randrange(k) for k in range(1, n))])
        leaf = np.array([k not in parent for k in range(n)])
        score = np.array([rnd.uniform(-3, 3) for _ in range(n)])
        kept = html_extract.decoded(score, parent, leaf)
        assert kept[0] and all(kept[parent[k]] for k in range(1, n) if kept[k])
        best = max((sum(score[k] for k in range(1, n) if pick >> k & 1) for pick in range(1, 1 << n, 2)
                    if all(not pick >> k & 1 or pick >> parent[k] & 1 for k in range(1, n))
                    and all(not pick >> k & 1 or leaf[k] or any(pick >> c & 1 for c in range(1, n) if parent[c] == k) for k in range(1, n))), default=0)
        assert score[1:][kept[1:]].sum() == pytest.approx(best)


def test_pages(spark, trees):
    page = ("<html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href='/a'>Home</a></li>"
            "<li><a href='/b'>More</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy this now.</div><article><h1>A &amp; B&nbsp;&#233;</h1>"
            "<p><b>First  line\n of text, which is long enough to be prose.<br><p>Second<i>ly</i>, more of the same text follows here.</p></article>"
            "<footer>&copy; x.example All rights.</footer>")
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "no markup at all & < 3"), (5, "u", "<" * 5000), (6, "u", "<div>" * 3000 + "x"),
            (7, "u", "<p title=\"unclosed>text"), (1, "u", page)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), keep=("url",), trees=trees).collect()
    want = "A & B é First line of text, which is long enough to be prose. Secondly, more of the same text follows here."
    assert [r.text for r in got if r.page_id == 1] == [want, want]
    assert all(r.n_chars == len(r.text) for r in got) and [r.text for r in got if r.page_id in (2, 3)] == ["", ""] and len(got) == len(rows)
    assert html_extract.extract(spark.createDataFrame([], "page_id long, html string"), trees=trees).collect() == []


PROBE = "<h1>On rivers</h1>" + "".join(
    f"<p>Paragraph {k} speaks about rivers, stones and the green house on the hill; it goes on for a while, as texts do.</p>" for k in range(12))
NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
FOOT = "<footer><p>&copy; 2020 Somebody</p></footer>"
CLASSES = ["with-sidebar", "overflow-hidden", "no-comments", "page-header-offset", "advertorial-free", "post", "has-comments nav-open"]


def probes():
    for c in CLASSES:
        yield f"<html><head><title>t</title></head><body>{NAV}<article class='{c}'>{PROBE}</article>{FOOT}</body></html>"
        yield f"<html><head><title>t</title></head><body class=\"{c}\">{NAV}<article>{PROBE}</article>{FOOT}</body></html>"
        yield f"<html><head><title>t</title></head><body><div class={c.split()[0]}>{NAV}<article>{PROBE}</article>{FOOT}</div></body></html>"
    yield f"<html><head><title>t</title><meta charset=utf-8>{NAV}<article>{PROBE}</article>{FOOT}"
    yield f"<html><head><script>var a = '<p>no</p>'</script><style>p{{}}</style>{NAV}<article>{PROBE}</article>{FOOT}"
    for tag in ("svg", "button", "select", "math", "object"):
        yield f"<html><head></head><body>{NAV}<{tag}><article>{PROBE}</article>{FOOT}</body></html>"
        yield f"<html><head></head><body>{NAV}<{tag}><article>{PROBE}</article><{tag}>x</{tag}>{FOOT}</body></html>"
        yield f"<html><head></head><body>{NAV}<article>{PROBE.replace('</h1>', f'</h1><{tag}>x</{tag}>')}</article>{FOOT}</body></html>"
    yield f"<html><body>{NAV}<article>{PROBE}<p hidden>gone</p><p class='hidden'>gone</p><p style='display: none'>gone</p></article>{FOOT}</body></html>"


@pytest.mark.parametrize("page", list(probes()))
def test_plain_pages_of_the_wild(trees, page):
    want = " ".join(re.sub(r"<[^>]+>", " ", PROBE).split())
    assert html_extract.main_texts([page], trees) == [want]


def test_dense_postings_as_blocks_equal_pairs(spark, monkeypatch):
    """Near copies of one text that do not link with each other: found block by block as by comparing all, with rows that follow the members."""
    rnd = random.Random(9)
    base = [f"w{k}" for k in range(60)]

    def made(m):
        out = []
        for k in range(m):
            words = list(base)
            words[rnd.randrange(60)] = f"new{k}"
            out.append((k, " ".join(words)))
        return out

    pairs, write = [], linking.written

    def counted(df, name):
        table = write(df, name)
        if name.endswith("-pairs"):
            pairs.append(table.count())
        return table

    monkeypatch.setattr(linking, "written", counted)
    totals = []
    for m in (200, 400):
        rows = made(m)
        pairs.clear()
        got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90).collect()}
        totals.append(sum(pairs))
        sets = [{tuple(t.split()[i:i + 3]) for i in range(58)} for _, t in rows]
        root = list(range(m))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a in range(m):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if 100 * both >= 90 * (116 - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
        assert [got[k] for k in range(m)] == [find(k) for k in range(m)]
        assert 20 < len(set(got.values())) < m / 2
    assert totals[1] < 2.5 * totals[0]


def test_overlaps_of_blocks():
    rnd = random.Random(2)
    sets = [[np.array(sorted(rnd.sample(range(40), rnd.randint(0, 20))), np.int64) for _ in range(n)] for n in (7, 5)]
    a, b = ((np.repeat(np.arange(len(side)), [len(s) for s in side]), np.concatenate(side)) for side in sets)
    want = [[len(np.intersect1d(x, y)) for y in sets[1]] for x in sets[0]]
    assert ngram_join.overlaps(a, b, 7, 5).tolist() == want
    none = np.zeros(0, np.int64)
    assert ngram_join.overlaps((none, none), b, 7, 5).sum() == 0


def test_one_row_of_equal_rows_with_maps(spark):
    """Rows equal in id and text that differ elsewhere, with a column that cannot be compared."""
    rows = spark.createDataFrame([(1, "a b c d e f g", {"x": 1}), (1, "a b c d e f g", {"x": 2}), (2, "q r s t u v w", None)], "doc_id long, text string, m map<string,int>")
    got = ngram_join.one_per_class(rows, words=5, percent=80).collect()
    assert sorted((r.doc_id, r.m) for r in got) == [(1, {"x": 1}), (2, None)]


def test_vectors_of_any_size(spark):
    """Angles alone decide, from the smallest to the largest doubles; zero and non-finite vectors link with nothing."""
    rows = [(1, [1e-150, 2e-150]), (2, [2e-150, 4e-150]), (3, [1e300, 2e300]), (4, [5e-324, 1e-323]), (5, [0.0, 0.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0]), (8, [2.0, -1.0])]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {k: (4, 1) for k in (1, 2, 3, 4, 7)} | {k: (0, k) for k in (5, 6, 8)}
