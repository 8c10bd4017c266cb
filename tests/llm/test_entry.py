"""Registered queries against their SQL, and the pipeline against a plain version of its stages."""

import itertools
import re

import public_tokenizers
import pytest
from compare import compare, connect
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import language_id, queries

NAMES = sorted(queries.QUERIES)


def test_every_operator_is_registered_once():
    assert [sum(n.startswith(f"op{k}_") for n in entry.queries()) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in NAMES if n in queries.SQL])
def test_matches_sql(spark, sf_small, name):
    problem, rows = compare(queries.QUERIES[name](spark, sf_small), connect(sf_small), queries.SQL[name])
    assert problem is None and rows


@pytest.mark.parametrize(("name", "table"), [(n, "pages" if n.startswith("op5") else "documents") for n in NAMES if n not in queries.SQL and not n.startswith(("op9", "op12"))])
def test_one_row_per_row(spark, sf_small, name, table):
    assert queries.QUERIES[name](spark, sf_small).count() == spark.read.parquet(f"{sf_small}/{table}.parquet").count()


def test_language_of_held_out_documents(spark, sf_mid):
    found = queries.QUERIES["op2_language_id"](spark, sf_mid).where("held_out")
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def plain_pipeline(rows, judge):
    """The stages in plain loops: texts by id after the fourth."""
    texts = {r.doc_id: r.text for r in rows if not judge(r.text)[3]}
    sets = {}
    for k, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0d]+", t.encode().lower())
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])) and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    bodies = {k: t.encode() for k, t in texts.items() if find(k) == k}
    size, count = corpus_pipeline.REPEATED_BYTES, {}
    for b in bodies.values():
        for i in range(len(b) - size + 1):
            count[b[i:i + size]] = count.get(b[i:i + size], 0) + 1
    out = {}
    for k, b in bodies.items():
        cut = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                cut[i:i + size] = b"\1" * size
        text = bytes(x for x, c in zip(b, cut, strict=True) if not c).decode("utf-8", "ignore")
        spans = [(m.start(), m.end()) for m in re.finditer(
            r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[1]) >= 8]
        spans += [m.span() for p in (r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}") for m in re.finditer(p, text)]
        at, parts = 0, []
        for a, e in sorted(spans):
            if a >= at:
                parts += [text[at:a], "[secret]"]
            at = max(at, e)
        out[k] = "".join(parts) + text[at:]
    return out


def test_pipeline(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    learned = language_id.learn(docs)
    want = plain_pipeline(docs.collect(), language_id.Classifier(learned))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {k: len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in want.items()}
    got = corpus_pipeline.run(spark, sf_small).collect()
    found = {}
    for r in got:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == sizes
    used = {r.sequence_id for r in got}
    assert len(used) <= sum(sizes.values()) / 2048 + 2


def test_stages_keep_the_columns(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_small)
        assert docs.dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
    assert docs.where("n_chars <> length(text)").isEmpty()


def test_stages_take_empty_tables_and_nulls(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for rows in (docs.limit(0), docs.selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars"),
                 docs.selectExpr("cast(null as long) doc_id", "text", "cast(null as string) lang", "source", "n_chars")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, sf_small).count() >= 0


def test_pipeline_keeps_repeated_and_nameless_texts_once(spark, sf_small, tmp_path):
    """Each document as two equal rows, some of them without an id: the same texts as from one row each."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").where("n_chars > 300").orderBy("doc_id").limit(40)
    once = docs.selectExpr("if(doc_id % 3 = 0, null, doc_id) doc_id", "text", "lang", "source", "n_chars")
    once.unionByName(once).write.parquet(str(tmp_path / "documents.parquet"))
    once.write.parquet(str(tmp_path / "single" / "documents.parquet"))

    def after_third(rows):
        for _, stage in corpus_pipeline.STAGES[1:3]:
            rows = stage(spark, rows, sf_small)
        return sorted(r.text for r in rows.collect())

    want = after_third(spark.read.parquet(str(tmp_path / "single" / "documents.parquet")))
    got = after_third(spark.read.parquet(str(tmp_path / "documents.parquet")))
    assert got == want and sum(map(len, got)) > 5000
