"""Quality rules by compression: bands of zstandard ratios over whole texts and fixed chunks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_engine.llm import words as W
from incident_engine.llm.batches import flat, free_name, map_texts


@dataclass(frozen=True)
class Band:
    """Limits of the ratio raw bytes / compressed bytes for texts of at most `up_to` bytes."""

    up_to: float
    least: float
    most: float


#: Short texts hardly compress, as a frame has a header, and long ones repeat more of their own words,
#: so both limits rise with length. They lie about a tenth beyond the extremes of texts labelled good.
WHOLE_BANDS = (
    Band(64, 0.55, 1.50),
    Band(128, 0.80, 1.70),
    Band(256, 0.95, 2.20),
    Band(512, 1.15, 2.20),
    Band(1024, 1.30, 2.25),
    Band(2048, 1.50, 2.30),
    Band(4096, 1.65, 2.45),
    Band(8192, 1.80, 2.55),
    Band(16384, 1.95, 2.65),
    Band(32768, 2.00, 2.70),
    Band(65536, 2.05, 2.80),
    Band(float("inf"), 2.05, 3.00),
)
#: Limits for every full chunk of a longer text; a text fails by chunks if over half of them do.
CHUNK_BYTES = 4096
CHUNK_BAND = Band(CHUNK_BYTES, 1.75, 2.55)
CHUNK_SHARE = 0.5
LEVEL = 3

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    + [T.StructField(n, T.DoubleType()) for n in ("ratio", "worst_chunk_share")]
)


def base_counts(column: pa.Array, window: int = 5) -> dict[str, np.ndarray]:
    """Counts of words, their code points, symbols, repeated lines and words in repeated windows."""
    data, offsets = flat(column)
    starts, ends, at = W.find_words(data, offsets)
    space = W.BLANK[data]
    out = {
        "n_words": np.diff(at),
        "word_chars": W.per_text(~space & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": W.per_text(SYMBOLS[data], offsets),
    }
    # lines: a text's own bounds cut them as well
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    of = np.searchsorted(offsets[1:], line_starts, "right")
    keep = of < len(column)
    line_starts, of = line_starts[keep], of[keep]
    nl = np.append(breaks, len(data))
    line_ends = np.minimum(nl[np.searchsorted(nl, line_starts)], offsets[1:][of])
    inked = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~space, out=inked[1:])
    full = inked[line_ends] > inked[line_starts]
    line_starts, line_ends, of = line_starts[full], line_ends[full], of[full]
    hashes = W.span_hashes(data, line_starts, line_ends)
    order = np.lexsort((hashes, of))
    same = (hashes[order][1:] == hashes[order][:-1]) & (of[order][1:] == of[order][:-1])
    out["n_dup_lines"] = np.bincount(of[order][1:][same], minlength=len(column))
    # windows of words found twice or more in their text
    n = int(at[-1])
    grams = W.shingle_hashes(W.span_hashes(data, starts, ends), window)
    first = np.flatnonzero(W.whole_windows(at, n, window))
    grams, of = grams[first], W.text_of(at)[first]
    order = np.lexsort((grams, of))
    g, o = grams[order], of[order]
    same = (g[1:] == g[:-1]) & (o[1:] == o[:-1])
    twice = np.zeros(len(g), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out["n_repeat_words"] = W.per_text(W.cover(first[order][twice], window, n), at)
    return out


def band_of(n_bytes: int, bands: tuple[Band, ...] = WHOLE_BANDS) -> Band:
    return next(b for b in bands if n_bytes <= b.up_to)


def compression(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of full chunks outside their band, and whether all is in band."""
    if not text:
        return 0.0, 0.0, False
    ratio = len(text) / len(packer.compress(text))
    band = band_of(len(text))
    chunks = [text[i : i + CHUNK_BYTES] for i in range(0, len(text) - CHUNK_BYTES + 1, CHUNK_BYTES)]
    out = sum(not CHUNK_BAND.least <= len(c) / len(packer.compress(c)) <= CHUNK_BAND.most for c in chunks)
    share = out / len(chunks) if chunks else 0.0
    return ratio, share, band.least <= ratio <= band.most and share <= CHUNK_SHARE


def _judge(column: pa.Array) -> list[pa.Array]:
    c = base_counts(column)
    failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    packer = zstandard.ZstdCompressor(level=LEVEL)
    seen = [compression(t.as_buffer().to_pybytes(), packer) for t in column.cast(pa.large_binary())]
    ratio, share, good = (np.array(x) for x in zip(*seen)) if seen else (np.zeros(0),) * 3
    return [pa.array(x) for x in (*c.values(), failed, ~failed & good.astype(bool), ratio, share)]


def quality_rules(docs: DataFrame, text: str = "text", name: str = "quality") -> DataFrame:
    """`docs` with a struct of counts, compression ratios and the verdict `kept` per row.

    A text passes if it has ten words or more, at most a fifth of them in repeated five-word
    windows, and ratios within the band of its length, whole and by chunks. Null and empty texts
    count as no words and fail. Texts are judged one by one, so repeated rows get equal verdicts.
    A column called `name` that exists already makes the new one end in underscores.
    """
    return map_texts(docs, text, free_name(docs, name), RESULT, _judge)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that pass the rules, with their own columns only."""
    judged = quality_rules(docs, text)
    return judged.where(F.col(f"`{judged.columns[-1]}`.kept")).select(*[f"`{c}`" for c in docs.columns])
