"""Language by compression: whichever language's zstandard dictionary makes a text smallest.

The dictionaries are raw content: excerpts of a bounded, documented sample of labelled rows. A text is compressed in
pieces of ``piece`` bytes, each against every dictionary, so that a long text can't outgrow the dictionary and become
its own; all pieces of the whole text count. A narrow margin between the two smallest sizes rejects the prediction.
"""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxlake.llm.common import map_text

LETTER = re.compile(r"[^\W\d_]")
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-cased letters, other runs as one space: case and decoration say nothing of the language."""
    return OTHER.sub(" ", text.lower())


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id's text leaves 2 on division by 4; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def dictionaries(docs: DataFrame, per_lang: int = 512, excerpt: int = 1024, most_langs: int = 256, id_col: str = "doc_id") -> dict[str, bytes]:
    """Raw content by language: of ``per_lang`` labelled rows, not held out, in order of a hash, ``excerpt`` characters each.

    Only these bounded samples reach the driver (most_langs x per_lang x excerpt characters: 134 million at most, of four
    bytes each in the worst case). More than ``most_langs`` languages are refused, so none is left out in silence. Their counts give each a bound on the hash that leaves about four times the
    sample, so that ranks are taken among few rows however many a language has; a second pass reads the texts of the chosen
    ids. Copies are taken once. Null ids count as one id.
    """
    ok = docs.filter(~held_out(id_col) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = ok.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    langs = counts.count()
    if langs > most_langs:
        raise ValueError(f"{langs} languages: raise most_langs ({most_langs}) and the driver's memory, or choose among them")
    # Hashes are spread evenly over 64 bits; a language of few rows has no bound.
    bound = F.when(F.col("n") > 4 * per_lang, (4.0 * per_lang / F.col("n") * 2.0 - 1.0) * 2.0**63)
    near = ok.select("lang", F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("h")).join(F.broadcast(counts.select("lang", bound.alias("most"))), "lang").filter(F.coalesce(F.col("h") <= F.col("most"), F.lit(True)))
    by = Window.partitionBy("lang").orderBy("h", "id")
    chosen = near.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= per_lang).select("lang", "id").distinct()
    texts = ok.select(F.col("lang").alias("_l"), F.col(id_col).alias("_i"), F.substring("text", 1, excerpt).alias("t"))
    texts = texts.join(F.broadcast(chosen), (F.col("_l") == F.col("lang")) & F.col("_i").eqNullSafe(F.col("id")), "left_semi").groupBy("_l", "_i").agg(F.min("t").alias("t"))
    out: dict[str, dict[str, None]] = {}
    for row in sorted(texts.collect(), key=lambda r: (r["_l"], r["_i"] is None, r["_i"] or 0)):
        out.setdefault(row["_l"], {})[row["t"]] = None
    return {lang: "\n".join(texts).encode() for lang, texts in out.items()}


class CompressionJudge:
    """Sizes of a text under each dictionary; built once for each task."""

    def __init__(self, content: dict[str, bytes], level: int, piece: int) -> None:
        self.langs, self.piece, self.coders = sorted(content), piece, []
        params = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=0, write_checksum=0, write_dict_id=0)
        for lang in self.langs:
            kept = zstandard.ZstdCompressionDict(letters(content[lang].decode()).encode() or b"\n" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            kept.precompute_compress(compression_params=params)
            self.coders.append(zstandard.ZstdCompressor(dict_data=kept, compression_params=params).compress)

    def sizes(self, text: str) -> list[int]:
        data, k = letters(text).encode(), self.piece
        parts = [data[a : a + k] for a in range(0, len(data), k)]
        return [sum([len(f(p)) for p in parts]) for f in self.coders]

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and margin: the share by which the second smallest size is larger. No letter, or nothing learned: und, 0."""
        if not text or not self.langs or not LETTER.search(text):
            return "und", 0.0
        sizes = self.sizes(text)
        first, *rest = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.langs[i]))
        return self.langs[first], (sizes[rest[0]] - sizes[first]) / sizes[rest[0]] if rest else 1.0


def predict(docs: DataFrame, content: dict[str, bytes], level: int = 6, piece: int = 2048, least_margin: float = 0.01, id_col: str = "doc_id", keep: list[str] = ()) -> DataFrame:
    """(id, lang_pred, score, rejected) of every whole text; lang, source and id are no input of a prediction.

    score is the margin, from 0 to 1; rejected is true below ``least_margin`` and for ``und``. Null texts and texts without
    a letter are ``und`` with score 0. Repeated rows give repeated rows; no shuffle. Columns of ``keep`` pass through.
    """

    def make():
        judge = CompressionJudge(content, level, piece)

        def f(part):
            found = [judge.judge(t) for t in part.column(1).to_pylist()]
            return [part.column(0), [a for a, _ in found], [b for _, b in found], [a == "und" or b < least_margin for a, b in found]]

        return f

    return map_text(docs, [id_col, "text"], make, f"{id_col} bigint, lang_pred string, score double, rejected boolean", keep)
