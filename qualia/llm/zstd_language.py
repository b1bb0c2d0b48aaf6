"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of a bounded sample of its labelled
texts. All of a text is compressed with every dictionary, in blocks of ``BLOCK`` bytes so that the
dictionary and not the text's own beginning tells it; the language with the smallest total is
predicted, and the relative saving over the second smallest is its score. Where the two smallest
are equal, another compression level decides. A prediction is accepted if the saving is
``min_margin`` bytes or more and the score is the model's ``margin`` or more.

The margin is learned: further labelled texts, the ``sample_rows`` next by hash that no dictionary has
seen, are predicted whole, and the score that all but ``lost`` of those
rightly predicted reach is the margin. A learned model asks for MIN_BYTES bytes too, since in short
texts a byte is a large share. A plain dict of dictionaries has margin 0 and asks for 1 byte.

The sample: per language ``sample_rows`` texts, the smallest by a hash of the text. Each gives ``piece``
characters to the dictionary, from a place anywhere in the text that another hash of it tells. Every labelled
language is learned; the model is at most ``sample_rows * piece`` characters for each of them.

Defined results: null text, or text without a letter: ``und``, score 0, not accepted. Equal sizes: the
first language by name. No labelled rows: every text is ``und``. Repeated rows give equal results;
an empty table gives no rows; ``predict`` reads two columns, ``keep_identified`` keeps all columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualia.llm.batches import slices

UNKNOWN = "und"
BLOCK = 1500
LEVELS = (6, 3, 12)
MIN_BYTES = 3
_LETTER = regex.compile(r"\p{L}")


class Model(dict):
    """Language -> dictionary content, with the margin (least score) and bytes that a prediction needs."""

    margin, min_bytes = 0.0, 1


def _accepted(model: dict[str, bytes], lang: str, score: float, saved: int, min_margin: int) -> bool:
    return (lang != UNKNOWN and saved >= max(min_margin, getattr(model, "min_bytes", 1))
            and score >= getattr(model, "margin", 0.0))


def learn_dictionaries(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_rows: int = 160,
                       piece: int = 800, lost: float = 0.01) -> Model:
    """Language -> dictionary content and the learned margin, from the labelled ``rows``."""
    src = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    src = src.withColumn("h", F.xxhash64("text"))
    langs = src.groupBy("lang").agg(F.approx_count_distinct("h").alias("texts")).collect()
    if not langs:
        return Model()
    # Twice the share of distinct texts that gives both samples, so that the exact top ones are among few candidates.
    shares = {row["lang"]: min(1.0, (4.0 * sample_rows + 50) / max(1, row["texts"])) for row in langs}
    best = _smallest(src, shares, 2 * sample_rows, piece)
    found = Counter(row["lang"] for row in best)
    # The distinct counts are approximate: a language whose candidates did not suffice is taken whole.
    short = {lang: 1.0 for lang, share in shares.items() if share < 1 and found[lang] < 2 * sample_rows}
    if short:
        best = [row for row in best if row["lang"] not in short] + _smallest(src, short, 2 * sample_rows, piece)
    parts: dict[str, list[str]] = {}
    for row in best:
        if row["i"] <= sample_rows:
            parts.setdefault(row["lang"], []).append(row["text"])
    model = Model({lang: _normal("\n".join(texts)).encode() for lang, texts in sorted(parts.items())})
    model.min_bytes = MIN_BYTES
    unseen = [(row["lang"], row["h"]) for row in best if row["i"] > sample_rows]
    scores = _right_scores(src, unseen, model) if unseen else []
    model.margin = scores[int(len(scores) * lost)] if scores else 0.0
    return model


def _smallest(src: DataFrame, shares: dict[str, float], rows: int, piece: int) -> list:
    """Per language of ``shares`` a piece of each of the ``rows`` texts with the smallest hashes, of those in that share of all hashes."""
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))[F.col("lang")]
    near = src.where((F.col("h").cast("double") / 2.0**64 + 0.5) <= share)
    place = F.pmod(F.xxhash64(F.lit("place"), "text"), F.greatest(F.lit(1), F.length("text") - piece + 1))
    near = near.select("lang", "h", F.substring("text", (place + 1).cast("int"), F.lit(piece)).alias("text")).dropDuplicates(["lang", "h"])
    order = Window.partitionBy("lang").orderBy("h", "text")
    return near.withColumn("i", F.row_number().over(order)).where(F.col("i") <= rows).orderBy("lang", "i").collect()


def _right_scores(src: DataFrame, chosen: list[tuple[str, int]], model: Model) -> list[float]:
    """Ascending scores of the rightly predicted ones of ``chosen`` (language, hash) labelled texts, each read whole."""
    wanted = F.broadcast(src.sparkSession.createDataFrame(chosen, "lang string, h long"))
    texts = src.join(wanted, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])
    model = src.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(model.value)
        for batch in slices(batches):
            found = [compressors.predict(t) for t in batch.column("text").to_pylist()]
            right = [score for lang, (said, score, _) in zip(batch.column("lang").to_pylist(), found) if said == lang]
            yield pa.RecordBatch.from_arrays([pa.array(right, pa.float64())], names=["score"])

    return sorted(row["score"] for row in texts.mapInArrow(run, "score double").collect())  # one of each chosen text at most


def _normal(text: str) -> str:
    return text.lower()


class Compressors:
    """One compressor per language and level; those of a level are made when a text first needs them."""

    def __init__(self, dictionaries: dict[str, bytes], levels: tuple[int, ...] = LEVELS):
        self.langs, self.dictionaries, self.levels = sorted(dictionaries), dictionaries, levels
        self.by_level: dict[int, list[zstandard.ZstdCompressor]] = {}

    def of_level(self, level: int) -> list[zstandard.ZstdCompressor]:
        if level not in self.by_level:
            self.by_level[level] = [_compressor(self.dictionaries[lang], level) for lang in self.langs]
        return self.by_level[level]

    def predict(self, text: str | None) -> tuple[str, float, int]:
        """Language, score in 0..1, and bytes saved against the second smallest."""
        if not self.langs or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0
        raw = _normal(text).encode()
        blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
        for level in self.levels:
            sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.of_level(level)]
            best = min(range(len(sizes)), key=sizes.__getitem__)
            second = min((s for i, s in enumerate(sizes) if i != best), default=len(raw) + 16)
            if second > sizes[best]:
                break
        return self.langs[best], max(0.0, 1.0 - sizes[best] / max(1, second)), max(0, second - sizes[best])


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=0, write_checksum=0, write_dict_id=0)
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params)


def predict(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
            min_margin: int = 1) -> DataFrame:
    """Per document: doc_id, lang_pred, score, saved_bytes, accepted."""
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(model.value)
        for batch in slices(batches):
            found = [compressors.predict(t) for t in batch.column("text").to_pylist()]
            lang, score, saved = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(saved, pa.int64()),
                 pa.array([_accepted(model.value, *f, min_margin) for f in found], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "saved_bytes", "accepted"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double, saved_bytes long, accepted boolean")


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: int = 1) -> DataFrame:
    """The rows whose language is accepted, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(model.value)
        for batch in slices(batches, text_col):
            found = [compressors.predict(t) for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([_accepted(model.value, *f, min_margin) for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
