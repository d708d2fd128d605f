"""Fill-in-the-middle transformation: texts cut at unit borders into prefix, middle and suffix, and put in another order.

A text's code points fall into four classes (newline, other white space, end of a sentence, the rest), and a wavelet
matrix over the classes answers how many of a class stand before a place. The ranks of the classes at which a unit ends
add up to the number of borders before a place, so the number of units is a sum of ranks at the text's end, and the
place of a border is found by bisection on these sums. A document's id alone decides about its cuts and its form.

Spark cuts and joins the pieces by their places; only places come from Python.

Defined results: a null text is the empty text, which stays plain; a null doc_id hashes as if it were empty; equal rows
give equal rows; texts of any length are taken whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import small_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OTHER, NEWLINE, SPACE, STOP = range(4)
#: Classes of code points at which a unit ends.
UNITS = {"line": (NEWLINE,), "sentence": (NEWLINE, STOP), "word": (NEWLINE, SPACE), "char": (OTHER, NEWLINE, SPACE, STOP)}
_CLASSES = np.zeros(129, np.uint8)  # the last entry stands for everything from 128 on
_CLASSES[ord("\n")] = NEWLINE
_CLASSES[[9, 11, 12, 13, 32]] = SPACE
_CLASSES[[ord(c) for c in ".!?"]] = STOP
#: Bits of a block of a bit vector, for which the ones before it are stored.
BLOCK_BITS = 512


def classes(text: str) -> np.ndarray:
    return _CLASSES[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)]


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        self.packed = np.packbits(bits, bitorder="little").tobytes()
        whole = np.zeros(-(-len(bits) // BLOCK_BITS) * BLOCK_BITS, np.uint8)
        whole[: len(bits)] = bits
        self.before = [0, *np.cumsum(whole.reshape(-1, BLOCK_BITS).sum(1, dtype=np.int64)).tolist()]

    def rank(self, at: int) -> int:
        block = at // BLOCK_BITS
        own = int.from_bytes(self.packed[block * BLOCK_BITS // 8 : (at + 7) // 8], "little")
        return self.before[block] + (own & ((1 << (at - block * BLOCK_BITS)) - 1)).bit_count()


class WaveletMatrix:
    """Ranks of small codes: a bit vector per bit of the codes, highest first, where each level sorts the codes before it
    by that bit and keeps their order otherwise."""

    def __init__(self, codes: np.ndarray, width: int = 2):
        self.size, self.width, self.levels, self.zeros = len(codes), width, [], []
        for shift in range(width - 1, -1, -1):
            bits = codes >> shift & 1
            self.levels.append(Bits(bits))
            codes = np.concatenate([codes[bits == 0], codes[bits == 1]])
            self.zeros.append(self.size - int(bits.sum()))
        self.starts = {c: self._down(c, 0) for c in range(1 << width)}

    def _down(self, code: int, at: int) -> int:
        for level, bits in enumerate(self.levels):
            ones = bits.rank(at)
            at = self.zeros[level] + ones if code >> (self.width - 1 - level) & 1 else at - ones
        return at

    def rank(self, code: int, at: int) -> int:
        """How often a code occurs before a place."""
        return self._down(code, at) - self.starts[code]


class Units:
    """The units of a text: each ends at a code point of one of some classes, the last one at the text's end at the latest."""

    def __init__(self, codes: np.ndarray, ends: tuple[int, ...]):
        self.matrix, self.ends, self.size = WaveletMatrix(codes), ends, len(codes)
        self.borders = self.count(self.size)
        self.n = self.borders + (self.size > 0 and int(codes[-1]) not in ends)

    def count(self, at: int) -> int:
        """Borders before a place."""
        return sum(self.matrix.rank(c, at) for c in self.ends)

    def cut(self, k: int) -> int:
        """The place after the first k units."""
        if k > self.borders:
            return self.size
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            if self.count(middle) < k:
                low = middle + 1
            else:
                high = middle
        return low


def _cuts(unit: str):
    ends = UNITS[unit]

    @F.pandas_udf("n long, first int, second int")
    def cuts(texts: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = []
        for text, x, y in zip(texts, a, b, strict=True):
            units = Units(classes(text), ends)
            x, y = x % (units.n + 1), y % (units.n + 1)
            rows.append((units.n, units.cut(min(x, y)), units.cut(max(x, y))))
        return pd.DataFrame(rows, columns=["n", "first", "second"])

    return cuts


def transform(docs: DataFrame, unit: str = "line", seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output (the new text), text."""
    small_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select("doc_id", text_or_empty().alias("text"), digest.alias("h"))
    h = [F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = rows.withColumn("cut", _cuts(unit)(F.col("text"), h[0], h[1]))
    marked = [F.contains("text", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("text") == "") | marked[0] | marked[1] | marked[2] | (h[2] % 100 >= percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    first, second = F.col("cut.first"), F.col("cut.second")
    prefix, middle, suffix = F.substring("text", F.lit(1), first), F.substring("text", first + 1, second - first), F.substring("text", second + 1, F.length("text"))
    parts = {"spm": (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle), "psm": (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)}
    output = F.col("text")
    for name, ps in parts.items():
        output = F.when(F.col("form") == name, F.concat(*(F.lit(p) if isinstance(p, str) else p for p in ps))).otherwise(output)
    cut = F.col("form") != "plain"
    return rows.withColumn("form", form).select(
        "doc_id", F.col("cut.n").alias("n"), "form", F.when(cut, first.cast("long")).alias("prefix_chars"), F.when(cut, (second - first).cast("long")).alias("middle_chars"), output.alias("output"), "text"
    )


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of a form was made of. No mark can arise where a piece meets a mark."""
    before, middle = F.split_part(output, F.lit(MIDDLE), F.lit(1)), F.split_part(output, F.lit(MIDDLE), F.lit(2))
    sides = {}
    for name, outer, inner in (("psm", PREFIX, SUFFIX), ("spm", SUFFIX, PREFIX)):
        one, two = F.split_part(before, F.lit(inner), F.lit(1)), F.split_part(before, F.lit(inner), F.lit(2))
        sides[name] = F.substring(one, F.lit(len(outer) + 1), F.length(one)), two
    psm, spm = F.concat(sides["psm"][0], middle, sides["psm"][1]), F.concat(sides["spm"][1], middle, sides["spm"][0])
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of the transformation by lines."""
    made = transform(docs)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


_H = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
u AS (SELECT *, CAST(CASE WHEN t = '' THEN 0 ELSE len(parts) - CASE WHEN parts[-1] = '' THEN 1 ELSE 0 END END AS BIGINT) AS n FROM d),
k AS (SELECT *, least({_H.format(1)} % (n + 1), {_H.format(9)} % (n + 1)) AS a, greatest({_H.format(1)} % (n + 1), {_H.format(9)} % (n + 1)) AS b FROM u),
c AS (
  SELECT *, least(length(t), coalesce(list_sum(list_transform(parts[1:a], lambda p: length(p) + 1)), 0)) AS x,
    least(length(t), coalesce(list_sum(list_transform(parts[1:b], lambda p: length(p) + 1)), 0)) AS y,
    CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR {_H.format(17)} % 100 >= 100 THEN 'plain'
      WHEN {_H.format(25)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, substr(t, 1, CAST(x AS BIGINT)) AS prefix, substr(t, CAST(x + 1 AS BIGINT), CAST(y - x AS BIGINT)) AS middle, substr(t, CAST(y + 1 AS BIGINT)) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(x AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(y - x AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
    WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
