"""Language of a text by compression: one raw-content dictionary per language, the smallest result wins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
PER_LANGUAGE = 300  # sampled documents per language
DICTIONARY_BYTES = 192 << 10  # raw content per language
PIECE_CHARS = 2000  # most that one sampled document gives
LANGUAGES = 2000  # most languages that can be learned; more is an error
BLOCK = 120  # bytes compressed at once: longer blocks are packed by their own letters and repeats, not by the dictionary
MIN_MARGIN = 0.004
LEAST_BYTES = 64  # shorter texts often match no dictionary at all; they are not rejected for that


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE,
          size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw dictionary content per language, from a bounded sample: ``per_language`` distinct texts, ``size`` bytes.

    The sample is the texts with the smallest hashes, each once however many copies it has, so it does not depend on ids, partitions or order.
    A long text gives PIECE_CHARS characters from a place that its hash chooses. Rows without a language or without a letter teach
    nothing; ids are not read. At most ``per_language`` pieces per language reach the driver. With no labelled row at all the result
    is empty, and every prediction is "und".
    """
    rows = docs.select(F.xxhash64(docs[text]).alias("h"), docs[lang].alias("lang"), docs[text].alias("value"))
    rows = rows.where("lang is not null and value rlike '\\\\p{L}'")
    counts = rows.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("h").alias("texts")).limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return {}
    # about twice as many texts as wanted have a hash below this share; fewer than wanted happens once in e**-80 for 300
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1 << 31, int(2 * per_language / max(1, r["texts"]) * (1 << 31)) + 1)) for r in counts], "lang string, share long")
    place = F.pmod(F.xxhash64("value", F.lit(5)), F.greatest(F.length("value") - PIECE_CHARS, F.lit(0)).cast("long") + 1).cast("int")
    picked = (rows.join(F.broadcast(shares), "lang").withColumn("u", F.pmod("h", F.lit(1 << 31))).where("u < share")
              .select("lang", "u", "h", F.substring(F.col("value"), place + 1, F.lit(PIECE_CHARS)).alias("piece"))
              .groupBy("lang", "u", "h").agg(F.min("piece").alias("piece")))
    first = Window.partitionBy("lang").orderBy("u", "h")
    pieces: dict[str, list[tuple[int, int, str]]] = {}
    for row in picked.withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_language).collect():
        pieces.setdefault(row["lang"], []).append((row["u"], row["h"], row["piece"]))
    out = {}
    for name in (r["lang"] for r in sorted(counts, key=lambda r: (-r["count"], r["lang"]))):
        found = pieces.get(name, [])
        parts, left = [], size
        for _, _, piece in sorted(found):
            raw = piece.lower().encode()[:left]
            parts.append(raw)
            left -= len(raw)
            if left <= 0:
                break
        out[name] = b"\n".join(reversed(parts))  # what is sampled first lies nearest to the text
    return out


class Classifier:
    """Compresses a whole text, block by block, once per language; the summed sizes decide, ties go to the language learned from more rows."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.packers = []
        how = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, window_log=18, hash_log=16, chain_log=17, search_log=5, min_match=4,
            target_length=0, write_checksum=False, write_content_size=False, write_dict_id=False)
        for name in self.names:
            raw = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=how)
            self.packers.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=how).compress)

    def __call__(self, text: str | None, min_margin: float = MIN_MARGIN) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected): margin is how much smaller the best result is than the second, as a share of that.

        The score is 1 / (sum over languages of exp(-excess / scale)), where excess is the bytes over the smallest result
        and scale grows with the root of that result, so that a few bytes decide a short text and more a long one.
        """
        if not text or not self.names or not LETTER.search(text):
            return UNDETERMINED, 0.0, 0.0, True
        raw = text.lower().encode()
        blocks = [raw[at:at + BLOCK] for at in range(0, len(raw), BLOCK)]
        sizes = [sum(map(len, map(pack, blocks))) for pack in self.packers]
        best = min(sizes)
        first = sizes.index(best)
        rest = sizes[:first] + sizes[first + 1:]
        margin = (min(rest) - best) / min(rest) if rest else 1.0
        scale = max(1.0, math.sqrt(best) / 4)
        score = 1.0 / (1.0 + sum(math.exp(-(s - best) / scale) for s in rest))
        return self.names[first], score, margin, margin < min_margin and len(raw) >= LEAST_BYTES


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id: str = "doc_id", text: str = "text",
             min_margin: float = MIN_MARGIN, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``keep`` columns, ``id``, lang_pred, score, margin, rejected.

    Whole texts are compressed. Null texts and texts without a letter are "und" with score 0 and rejected; other texts
    get the language of the smallest result, and are rejected where it is less than ``min_margin`` smaller than the second best and
    the text has ``LEAST_BYTES`` bytes. Rows are judged one by one, so repeated rows get equal results; other columns are not read.
    """
    kept = [c for c in keep if c not in (id, text)]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(dictionaries)
        for part in slices(batches, "__text"):
            found = [judge(value, min_margin) for value in part["__text"].to_pylist()]
            columns = {name: part[name] for name in part.schema.names if name != "__text"}
            columns["lang_pred"] = pa.array([f[0] for f in found], pa.string())
            columns["score"] = pa.array([f[1] for f in found], pa.float64())
            columns["margin"] = pa.array([f[2] for f in found], pa.float64())
            columns["rejected"] = pa.array([f[3] for f in found], pa.bool_())
            yield pa.RecordBatch.from_pydict(columns)

    fields = ", ".join(f"`{c}` {kinds[c]}" for c in [id, *kept])
    return docs.select(docs[id], *(docs[c] for c in kept), docs[text].alias("__text")).mapInArrow(
        run, f"{fields}, lang_pred string, score double, margin double, rejected boolean")


def clean(docs: DataFrame, dictionaries: dict[str, bytes], id: str = "doc_id", text: str = "text",
          min_margin: float = MIN_MARGIN) -> DataFrame:
    """The documents that are not rejected, with their columns as they were."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(dictionaries)
        for part in slices(batches, text):
            yield part.filter(pa.array([not judge(value, min_margin)[3] for value in part[text].to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
