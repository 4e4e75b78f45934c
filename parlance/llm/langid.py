"""Operator 5, language ID by compression with per-language zstandard dictionaries.

For every language a raw-content dictionary is filled with whole training texts (a bounded
sample). A text is compressed once with each dictionary; the smallest result names the
language. The margin between the best and the second-best size, relative to the best, is
turned into a score; narrow margins are flagged as rejected.

The sample: per language at most ``DICT_BYTES`` bytes, taken from the texts with the smallest
text hashes among the training rows (about ``2 * DICT_BYTES`` a language reach the driver).

Edge cases: null texts and texts without a letter are ``und`` with score 0; ties go to the
language with more training rows, then by name; without training rows every text is ``und``;
repeated rows give repeated rows; only the id, text and label columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import map_arrow

#: Bytes of one language's dictionary.
DICT_BYTES = 1 << 17
#: zstandard level of the classification.
LEVEL = 3
#: Relative margin under which a prediction is rejected, and the scale of the score.
MIN_MARGIN = 0.01
MARGIN_SCALE = 0.02
#: Languages whose dictionaries fit the broadcast (128 KB each).
MAX_LANGUAGES = 1000

_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def dictionaries(train: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary content), most frequent language first. A text contributes whole;
    the dictionary is cut at its end only, where the last text may exceed the bound."""
    rows = train.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t")).where(
        F.col("lang").isNotNull() & F.col("t").rlike(r"\p{L}"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("t")).alias("bytes")).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return []
    # rows whose hash falls into a share of the hash range that holds about 2 * dict_bytes; the
    # share grows for the languages whose dictionary it does not fill
    share = {r["lang"]: min(1.0, 2.0 * dict_bytes / max(1, r["bytes"])) for r in sizes}
    h = F.pmod(F.xxhash64("t"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    texts: dict[str, list[bytes]] = {}
    while share:
        bound = F.create_map(*[F.lit(x) for r in share.items() for x in r])
        picked = rows.where(h < F.try_element_at(bound, F.col("lang"))).select(
            "lang", F.substring(F.col("t").cast("binary"), 1, dict_bytes).alias("t"), h.alias("h"))
        room = dict.fromkeys(share, dict_bytes)
        texts.update((name, []) for name in share)
        for r in picked.distinct().orderBy("lang", "h", "t").toLocalIterator():
            if room[r["lang"]] > 0:
                t = bytes(r["t"])[:room[r["lang"]]]
                texts[r["lang"]].append(t)
                room[r["lang"]] -= len(t) + 1
        share = {name: min(1.0, 8 * s) for name, s in share.items() if room[name] > 0 and s < 1.0}
    order = sorted(sizes, key=lambda r: (-r["n"], r["lang"]))
    # the earliest bytes of a dictionary are the farthest away, so the order is reversed
    return [(r["lang"], b"\n".join(reversed(texts.get(r["lang"], [])))) for r in order]


class Classifier:
    def __init__(self, dicts: list[tuple[str, bytes]], level: int = LEVEL):
        self.langs = [name for name, _ in dicts]
        self.codecs = []
        for _, content in dicts:
            d = zstandard.ZstdCompressionDict(self.normal(content), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.codecs.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))

    @staticmethod
    def normal(text: bytes) -> bytes:
        """ASCII letters and non-ASCII bytes; everything else is one space."""
        return b" ".join(text.translate(_LETTERS).split())

    def sizes(self, text: bytes) -> list[int]:
        return [len(c.compress(text)) for c in self.codecs]

    def predict(self, text: bytes) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        if not self.langs:
            return "und", 0.0, True
        sizes = self.sizes(self.normal(text))
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1:]
        if not others:
            return self.langs[best], 1.0, False
        margin = (min(others) - sizes[best]) / max(1, sizes[best])
        return self.langs[best], 1.0 - 0.5 * math.exp(-margin / MARGIN_SCALE), margin < MIN_MARGIN


def predict(docs: DataFrame, dicts: list[tuple[str, bytes]], id_col: str = "doc_id", text_col: str = "text",
            extra: dict[str, Column] | None = None) -> DataFrame:
    """(id, lang_pred, score, rejected) of every row, and the ``extra`` columns."""
    shared = docs.sparkSession.sparkContext.broadcast(dicts)
    extra = extra or {}
    extra_names = list(extra)
    # lower-casing lets a word at the start of a sentence match the same word inside one
    src = docs.select(F.col(id_col).alias("id"), F.when(F.col(text_col).rlike(r"\p{L}"), F.lower(text_col)).alias("t"),
                      *[c.alias(n) for n, c in extra.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier([(n, d.decode("utf-8", "ignore").lower().encode()) for n, d in shared.value])
        for b in batches:
            out = [model.predict(t.as_buffer().to_pybytes()) if t.is_valid else ("und", 0.0, True) for t in b.column(1)]
            lang, score, rejected = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], names=["id", *extra_names, "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "t")
    return map_arrow(src, run, f"{fields}, lang_pred string, score double, rejected boolean").withColumnRenamed(
        "id", id_col)
