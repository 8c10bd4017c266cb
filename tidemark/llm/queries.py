"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import (
    alignment, best_fit, byte_bpe, embedding_dedup, html_extract, language_id, license_scan, ngram_join, secrets, spot_signatures, suffix_dedup,
    token_counts, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


NGRAM_SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') as g
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
links as (select a, b from l union all select b, a from l),
reach(a, b) as (select a, b from links union select r.a, k.b from reach r join links k on r.b = k.a),
low as (select a, min(b) as b from reach group by a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) as component_id
from documents d left join n using (doc_id) left join low on low.a = d.doc_id
"""


@query("op1_ngram_join", NGRAM_SQL)
def op1(spark, sf_dir):
    return ngram_join.join(table(spark, sf_dir, "documents"), words=3, percent=90)


def held_out(id: str = "doc_id"):
    return F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0


@query("op2_language_id")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    learned = language_id.learn(docs.where(~held_out()))
    found = language_id.identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


@query("op3_spot_signatures")
def op3(spark, sf_dir):
    found = spot_signatures.with_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
                        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next", "component_id")


@query("op4_suffix_dedup")
def op4(spark, sf_dir):
    # with the texts as they are after the cuts: the digests alone do not show which passages are gone
    return suffix_dedup.digests(table(spark, sf_dir, "documents"), remaining="text")


@query("op5_html_extract")
def op5(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"), keep=("url",))


@query("op6_license_scan")
def op6(spark, sf_dir):
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"),
                        F.array_join(spans, ",").alias("spans"))


def _marked(k: int, kind: str, pattern: str, least: int) -> str:
    """Parts of each text: what stands before the first match, then each match (before and after chr(4)), chr(2) and what follows it."""
    return (f"select doc_id, {k} as k, '{kind}' as kind, {least} as least, string_split(regexp_replace(s, '{pattern}', "
            "chr(1) || '\\1' || chr(4) || '\\2' || chr(2), 'g'), chr(1)) as p from t")


_KEYS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in ("password", "passwd", "secret", "token", "api_?key"))
SECRETS_SQL = f"""
with t as (select doc_id, translate(coalesce(text, ''), chr(1) || chr(2) || chr(4), chr(3) || chr(3) || chr(3)) as s from documents),
m as ({_marked(0, 'assign', f"""((?:{_KEYS})["'']?[ ]*[:=][ ]*["'']?)([A-Za-z0-9+/_.=-]+)""", 8)}
  union all {_marked(1, 'access', '()(AKIA[A-Z0-9]+)', 16)}
  union all {_marked(2, 'hex', '()([0-9a-f]{32,})', 32)}),
e as (select doc_id, k, kind, least, unnest(p) as piece, generate_subscripts(p, 1) as i from m where len(p) > 1),
f as (select *, sum(length(piece) - case when i > 1 then 2 else 0 end) over (
  partition by doc_id, k order by i rows between unbounded preceding and 1 preceding) as start from e),
hits as (select doc_id, k, kind, start::bigint as start, (start + strpos(piece, chr(2)) - 2)::bigint as stop from f
  where i > 1 and strpos(piece, chr(2)) - strpos(piece, chr(4)) - 1 >= least),
g as (select doc_id, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access,
  count(*) filter (where k = 2) as n_hex, string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) as spans
  from hits group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join g using (doc_id)
"""


@query("op7_secrets", SECRETS_SQL)
def op7(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    listed = secrets.listed()
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed.cast("binary"), 256).alias("base_sha256"), listed.alias("spans"))


VECTORS_SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
low as (select a, min(b) as b from reach group by a),
n as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(n.n, 0) as n_links, least(e.vec_id, coalesce(low.b, e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce(low.b, e.vec_id)) as kept
from embeddings e left join n on n.a = e.vec_id left join low on low.a = e.vec_id
"""


@query("op8_embedding_dedup", VECTORS_SQL)
def op8(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op9_best_fit")
def op9(spark, sf_dir):
    return best_fit.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_byte_bpe")
def op10(spark, sf_dir):
    return byte_bpe.digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op11_token_counts")
def op11(spark, sf_dir):
    return token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op12_whitening")
def op12(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # exact as a decimal too, where many rows make it larger than a long
    return found.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained",
                        "identity_error", F.col("deviation").alias("deviation_exact"))


@query("op13_alignment")
def op13(spark, sf_dir):
    return alignment.compare(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
