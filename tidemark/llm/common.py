"""Shared helpers: names that cannot clash, row numbers, word splitting and subword ids."""

from __future__ import annotations

import os
import struct
import unicodedata
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

TOKENIZER = "word_bpe_49k.json"
#: Words that one Python worker remembers; more start a new memory. Only speed depends on it.
REMEMBERED_WORDS = 600_000


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet, whatever extra columns it brings."""
    taken = {c.lower() for c in df.columns}
    return next(n for k in count() if (n := f"_{wanted}{k or ''}").lower() not in taken)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def row_hash(df: DataFrame) -> Column:
    """128 bits over all columns of a row as text; equal rows have equal hashes, a null counts where it stands."""
    plain = [F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) if t.startswith(("map", "variant", "struct", "array")) else F.col(f"`{c}`") for c, t in df.dtypes]
    marked = [x for c in plain for x in (c.isNull(), c)]
    return F.concat_ws(":", *[F.hex(F.xxhash64(F.lit(seed), *marked)) for seed in (0, 1)])


def numbered(df: DataFrame, *order: str, number: str = "row_number", population: str = "population") -> DataFrame:
    """``df`` with a gapless number from 0 in the given order and the number of rows.

    The rows are range-partitioned on the order and then on their place in the
    input, so many equal rows still fill many ranges. The sorted ranges are
    checkpointed, which fixes them before their sizes are summed up.
    """
    keys = [F.col(f"`{c}`") for c in order]
    ranges = max(32, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tie, place, part = free_name(df, "tie"), free_name(df, "place"), free_name(df, "part")
    spread = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(ranges, *keys, F.col(tie)).sortWithinPartitions(*keys, tie)
    placed = cut_lineage(spread.drop(tie).withColumn(place, F.monotonically_increasing_id())).withColumn(part, F.shiftright(place, 33))
    # One row for each range reaches this window.
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = placed.groupBy(part).agg(F.count("*").alias("_rows")).select(part, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"), F.sum("_rows").over(everything).alias(population))
    return placed.join(starts, part).withColumn(number, F.col("_start") + F.col(place).bitwiseAND(F.lit((1 << 33) - 1))).drop(part, place, "_start")


def words_of(text: bytes | None) -> list[bytes]:
    """Words of the ASCII-lower-cased text; white space is space, tab, LF, VT, FF and CR."""
    return (text or b"").lower().split()


class WordIds(dict):
    """Subword ids of words as little-endian unsigned 32-bit bytes, looked up once and then remembered.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are the ids of its words in order. Marks at the end of a word are a
    piece of their own, so they are looked up apart.
    """

    TAIL = b".,;:!?"

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = self.tokenizer.model.tokenize
        self.remembered = remembered
        # Byte-level models show bytes without a visible character of their own as code points from 256 on.
        visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        self.shown = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(visible)))}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.remembered:
            self.clear()
        if word.isalpha() and word.islower():
            shown = word.decode()
        else:
            core = word.rstrip(self.TAIL)
            if len(core) < len(word) and core and (core[-1:].isalnum() or core[-1] >= 128 and self._ends_in_letter(core)):
                found = self[core] + self[word[len(core) :]]
                self[word] = found
                return found
            shown = self._shown(word)
        ids = self._whole(word) if shown is None else [t.id for t in self.split(shown)]
        found = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    @staticmethod
    def _ends_in_letter(word: bytes) -> bool:
        """Whether the tokenizer sees a letter at the end: a dotted capital I, for one, becomes a letter and a combining dot."""
        last = word.decode("utf-8", "replace")[-1]
        return last.isalpha() and unicodedata.normalize("NFC", last).lower()[-1].isalpha()

    def _shown(self, word: bytes) -> str | None:
        """A word with letters beyond ASCII as the model reads it, if normalizing and splitting leave it whole: lower-case Latin letters only."""
        if word.isascii():
            return None
        text = word.decode("utf-8", "replace")
        plain = text.isalpha() and max(text) < "\u0250" and text == text.lower() and unicodedata.is_normalized("NFC", text)
        return word.decode("latin-1").translate(self.shown) if plain else None

    def _whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids

    def of_words(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.__getitem__, words))

    def of_text(self, text: bytes | None) -> bytes:
        """The ids of a whole text, letter case as the tokenizer treats it."""
        text = text or b""
        if b"<|" in text:
            ids = self._whole(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        return self.of_words(text.lower().split())


_word_ids: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One memory of words for each Python worker."""
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return _word_ids[path]
