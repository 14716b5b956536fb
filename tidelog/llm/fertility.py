"""Quality rules by tokeniser fertility.

A public vocabulary cuts every word of a text. Three measures follow: characters per
token, the share of tokens that are raw bytes because no piece fits (byte fallback), and
the entropy of the text's tokens. Text of a language keeps close to that language's usual
values; listings, shouting, symbol noise and repeated runs do not. Each language (or
script, where no language is given) and length class gets a band around its median, as
wide as the middle of its texts is wide; texts outside any band are rejected.

The bands are counted over all distinct texts, however many copies a text has. Their number has a fixed bound, as languages are
codes of two or three letters, scripts are a fixed list and length classes are powers of two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.frames import free_name, written_table
from tidelog.llm.pieces import Pieces, held

#: Bytes of texts that are measured at a time.
SLICE_BYTES = 1 << 20
#: Fewer words than this fail, as does a larger share of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 20, 0.30
#: Half width of a band in spreads. A spread is half the distance between the quartiles,
#: or the floor if that is more.
WIDTH = 7.0
FLOORS = {"chars_per_token": 0.03, "fallback_share": 0.005, "entropy": 0.08}
MEASURES = tuple(FLOORS)

SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_tokens bigint, chars_per_token double, fallback_share double, "
    "entropy double, script string, base_failed boolean"
)

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

#: Scripts by the first byte of UTF-8: fixed values.
SCRIPT_NAMES = ("none", "latin", "greek", "cyrillic", "semitic", "indic", "asian", "other")
SCRIPT_OF = np.full(256, 0, np.int8)
SCRIPT_OF[ord("A") : ord("Z") + 1] = 1
SCRIPT_OF[ord("a") : ord("z") + 1] = 1
SCRIPT_OF[0xC3:0xCA] = 1
SCRIPT_OF[0xCD:0xD0] = 2
SCRIPT_OF[0xD0:0xD4] = 3
SCRIPT_OF[0xD6:0xDC] = 4
SCRIPT_OF[0xE0] = 5
SCRIPT_OF[0xE1:0xE3] = 7
SCRIPT_OF[0xE3:0xEE] = 6
SCRIPT_OF[0xEE:0xF5] = 7


def _vocabulary(path: str) -> tuple[Pieces, np.ndarray]:
    return held(("fertility", path), lambda: _pieces(path))


def _pieces(path: str) -> tuple[Pieces, np.ndarray]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    fallback = np.array([model.IsByte(i) for i in range(model.GetPieceSize())])

    def encode(values: list[bytes]) -> list[list[int]]:
        return model.encode([v.decode("utf-8", "replace") for v in values], num_threads=1)

    return Pieces(encode), fallback


def _measured(texts: pa.Array, vocabulary: str) -> dict[str, np.ndarray]:
    pieces, fallback = _vocabulary(vocabulary)
    found = T.words(texts)
    n = len(texts)
    n_words = np.diff(found.first)
    codes, distinct = T.coded(found.values())
    begins = ~T.CONTINUES[found.data]
    word_chars = T.per_text(found.ends, begins & ~T.SPACE[found.data])
    text, line, _ = T.lines(texts)
    n_lines = np.bincount(text, minlength=n)
    seen = np.unique(line * (n + 1) + text)
    own_lines = np.bincount(seen % (n + 1), minlength=n)
    repeated = T.repeated_words(found, codes)
    n_repeat = np.bincount(found.text, weights=repeated, minlength=n).astype(np.int64)

    ids, counts = pieces.ids(codes, distinct)
    of = np.repeat(found.text, counts)
    n_tokens = np.bincount(of, minlength=n)
    raw = np.bincount(of, weights=fallback[ids], minlength=n)
    key = np.sort(of * len(fallback) + ids)
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    times = np.diff(np.append(head, len(key)))
    spent = np.bincount(key[head] // len(fallback), weights=times * np.log2(times), minlength=n)
    some = np.maximum(n_tokens, 1)
    kinds = SCRIPT_OF[found.data]
    by_script = np.stack(
        [T.per_text(found.ends, kinds == k) for k in range(1, len(SCRIPT_NAMES))]
    )
    script = np.where(by_script.max(0, initial=0) > 0, by_script.argmax(0) + 1, 0)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": T.per_text(found.ends, SYMBOL[found.data]),
        "n_dup_lines": n_lines - own_lines,
        "n_repeat_words": n_repeat,
        "n_tokens": n_tokens,
        "chars_per_token": word_chars / some,
        "fallback_share": raw / some,
        "entropy": np.where(n_tokens > 0, np.log2(some) - spent / some, 0.0),
        "script": np.array(SCRIPT_NAMES, object)[script],
        "base_failed": (n_words < LEAST_WORDS)
        | (100 * n_repeat > round(100 * MOST_REPEATED) * n_words),
    }


def measures(text: Column, vocabulary: str) -> Column:
    """A struct of counts and fertility measures of ``text`` (null: no words).

    Each word is cut by itself by the sentencepiece model at ``vocabulary``.
    """
    kinds = [part.strip().split(" ") for part in SCHEMA.split(",")]
    arrow = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}

    @F.arrow_udf(SCHEMA)
    def measure(values: pa.Array) -> pa.Array:
        parts = [_measured(part, vocabulary) for _, part in T.slices(T.plain(values), SLICE_BYTES)]
        columns = [
            pa.array(np.concatenate([p[name] for p in parts]) if parts else [], arrow[kind])
            for name, kind in kinds
        ]
        return pa.StructArray.from_arrays(columns, [name for name, _ in kinds])

    return measure(text)


def band_key(lang: Column, script: Column) -> Column:
    """The language if it is a code of two or three letters, else the script."""
    code = F.lower(F.trim(lang))
    return F.when(code.rlike("^[a-z]{2,3}$"), code).otherwise(F.concat(F.lit("script:"), script))


def length_class(n_words: Column) -> Column:
    """Powers of two of the number of words."""
    return F.floor(F.log2(F.greatest(n_words, F.lit(1)).cast("double"))).cast("int")


def bands(measured: DataFrame) -> DataFrame:
    """Low and high bounds of each measure by band_key and length_class.

    ``measured`` holds those two columns, the measures and text_hash, one row per document that
    passed the base rules; rows alike in all of these count once. At most 18,252 language codes
    and 8 scripts by 64 length classes.
    """
    once = measured.select("band_key", "length_class", "text_hash", *MEASURES).distinct()
    middle = once.groupBy("band_key", "length_class").agg(
        *[
            F.percentile_approx(name, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(name)
            for name in MEASURES
        ]
    )
    bounds = []
    for name, floor in FLOORS.items():
        low, mid, high = (F.col(name)[i] for i in range(3))
        spread = F.greatest((high - low) / 2, F.lit(floor))
        bounds += [
            (mid - WIDTH * spread).alias(f"{name}_low"),
            (mid + WIDTH * spread).alias(f"{name}_high"),
        ]
    return middle.select("band_key", "length_class", *bounds)


def measured_rows(
    docs: DataFrame, vocabulary: str, text: str, lang: str | None, keep: list[str]
) -> tuple[DataFrame, str]:
    """Columns ``keep`` and a struct of measures and band keys, stored; and its column's name."""
    column = free_name(docs, "fertility")
    found = docs.withColumn(column, measures(F.col(text), vocabulary))
    code = F.col(lang) if lang else F.lit(None).cast("string")
    found = found.withColumn(
        column,
        F.struct(
            f"{column}.*",
            band_key(code, F.col(column)["script"]).alias("band_key"),
            length_class(F.col(column)["n_words"]).alias("length_class"),
            F.xxhash64(F.col(text)).alias("text_hash"),
        ),
    )
    return written_table(found.select(*keep, column), "fertility"), column


def fields_of(stored: DataFrame, column: str) -> list[str]:
    """Names of the fields of a struct column."""
    return stored.schema[column].dataType.names


def judged(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    lang: str | None = "lang",
    keep: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` (or columns ``keep``) with a struct; and its column's name.

    The struct holds the measures, the reasons (``base_failed`` and one flag per measure
    outside its band) and ``kept``. Null and empty texts have no words and fail. Copies of a text
    count once for the bands and are judged alike; without a language the script's bands hold; other columns of
    any name pass through. An empty table gives an empty table.
    """
    keep = docs.columns if keep is None else keep
    stored, column = measured_rows(docs, vocabulary, text, lang, keep)
    fields = F.col(column)
    bounds = written_table(
        bands(stored.where(~fields["base_failed"]).select(f"{column}.*")), "bands"
    )
    limits = free_name(stored, "limits")
    keys = ["band_key", "length_class"]
    others = [name for name in bounds.columns if name not in keys]
    bounds = bounds.select(*[F.col(k).alias(f"{limits}_{k}") for k in keys], F.struct(*others).alias(limits))
    both = stored.join(
        bounds,
        [fields[k] == F.col(f"{limits}_{k}") for k in keys],
        "left",
    )
    outside = {
        f"{name}_out": ~F.coalesce(
            fields[name].between(F.col(limits)[f"{name}_low"], F.col(limits)[f"{name}_high"]), F.lit(True)
        )
        for name in MEASURES
    }
    kept = ~fields["base_failed"]
    for out in outside.values():
        kept = kept & ~out
    shown = [fields[name].alias(name) for name in fields_of(stored, column) if name != "text_hash"]
    verdict = F.struct(*shown, *[c.alias(n) for n, c in outside.items()], kept.alias("kept"))
    return both.select(*keep, verdict.alias(column)), column


def fertility_rules(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per document: its id, counts, measures, reasons and ``kept``."""
    found, column = judged(docs.select(id_col, text, lang), vocabulary, text, lang, [id_col])
    return found.select(id_col, f"{column}.*")
