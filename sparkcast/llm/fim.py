"""Fill-in-the-middle: documents cut at two unit borders and put in another order.

A document has n units (lines, or code points). Three pieces, prefix, middle
and suffix, end at units that hashes of its id choose; the output puts them in
the order suffix-prefix-middle or prefix-suffix-middle behind sentinels.

Cuts are found without splitting texts. The UTF-8 bytes of a block of rows are
viewed as 64-bit words; arithmetic on a whole word marks the bytes that end a
line or begin a code point (the high bit of each such byte), ``bitwise_count``
gives the marks of a word, and their running sum ranks any byte. The k-th unit
of a row is then a binary search for the word that holds its mark, and the mark
inside the word is found by arithmetic on that word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.queries import register
from sparkcast.llm.shared import numbered, read_table
from sparkcast.llm.words import blocks, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Per hundred documents: those transformed, and of these, those in SPM order.
RATE, SPM_RATE = 100, 50
#: Bytes of text worked on at once.
BLOCK = 2 << 20

_U = np.uint64
_ONES = _U(0x0101010101010101)
_HIGH = _U(0x8080808080808080)
_LOW7 = _U(0x7F7F7F7F7F7F7F7F)


def line_ends(x: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line break, exactly (no carries between bytes)."""
    y = x ^ (_ONES * _U(0x0A))
    return ~(((y & _LOW7) + _LOW7) | y | _LOW7)


def char_starts(x: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is not a continuation byte (10xxxxxx)."""
    return (~x | (x << _U(1))) & _HIGH


class Marks:
    """Rank and select over the marked bytes of a block."""

    def __init__(self, words: np.ndarray, mark):
        self.marks = mark(words)
        self.sums = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.marks), out=self.sums[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before byte ``at``."""
        word, rest = at >> 3, (at & 7).astype(_U)
        below = (_U(1) << (rest << _U(3))) - _U(1)
        return self.sums[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte of the mark with number ``k``, from 0; there must be one."""
        word = np.searchsorted(self.sums, k, side="right") - 1
        # each byte of ``upto`` counts the marks of the word up to this byte
        upto = (self.marks[word] >> _U(7)) * _ONES
        need = (k - self.sums[word] + 1).astype(_U)
        short = ~((upto | _HIGH) - need * _ONES) & _HIGH
        return word * 8 + np.bitwise_count(short)


def as_words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian 64-bit words, with 8 to 15 zero bytes behind."""
    padded = np.zeros(len(data) // 8 * 8 + 16, dtype=np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def unit_cuts(words, rows, pick, unit: str):
    """(units of each row, byte of the first cut, byte of the second cut).

    ``pick`` holds two numbers a row; a cut follows number % (units + 1) units.
    """
    begin, end = rows[:-1], rows[1:]
    marks = Marks(words, line_ends if unit == "line" else char_starts)
    before = marks.rank(begin)
    n = marks.rank(end) - before
    if unit == "line":  # text after the last break is a line, too
        last = (words[(end - 1) >> 3] >> (((end - 1) & 7).astype(_U) << _U(3))) & _U(0xFF)
        n += (end > begin) & (last != 0x0A)
    chosen = [p % (n + 1) for p in pick]
    cuts = []
    for k in (np.minimum(*chosen), np.maximum(*chosen)):
        # lines: after the k-th break; code points: before the start number k
        inner = (k > 0) & (k < n)
        at = np.where(k > 0, end, begin)
        if inner.any():
            nth = before[inner] + k[inner]
            at[inner] = marks.select(nth - 1) + 1 if unit == "line" else marks.select(nth)
        cuts.append(at)
    return n, *cuts


def _block(text: pa.Array, pick, plain, spm, unit: str):
    """(units, code points of prefix and middle, outputs) of a block's rows."""
    data, rows = text_bytes(text)
    words = as_words(data)
    n, a, b = unit_cuts(words, rows, pick, unit)
    chars = Marks(words, char_starts)
    at_start, at_a, at_b = (chars.rank(x) for x in (rows[:-1], a, b))
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    raw = data.tobytes()
    out = []
    for i, (start, x, y, end) in enumerate(
        zip(rows[:-1].tolist(), a.tolist(), b.tolist(), rows[1:].tolist())
    ):
        if plain[i]:
            out.append(raw[start:end])
        elif spm[i]:
            out.append(b"".join((s, raw[y:end], p, raw[start:x], m, raw[x:y])))
        else:
            out.append(b"".join((p, raw[start:x], s, raw[y:end], m, raw[x:y])))
    return n, at_a - at_start, at_b - at_a, out


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "line",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """Fill-in-the-middle form of every document, one row a row.

    Returns ``id_col``, ``n`` (units), ``form`` (plain, psm or spm),
    ``prefix_chars``, ``middle_chars`` (code points, NULL if plain) and
    ``fim_text``. ``unit`` is ``line`` (a break ends its line) or ``char``.

    NULL text counts as empty; empty texts and texts that hold a sentinel stay
    plain. The choice follows the id alone, so rows equal in id are cut by the
    same numbers; a NULL id counts as an empty one. Other columns are not
    read. An empty table gives an empty table.
    """
    if unit not in ("line", "char"):
        raise ValueError("unit is line or char")
    renamed, names = numbered(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    key, text = names[id_col], names[text_col]
    digest = F.sha2(
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256
    )

    def h(i):
        return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")

    whole = F.coalesce(F.col(text), F.lit(""))
    held = whole == ""
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains(whole, F.lit(sentinel))
    rows = renamed.select(
        F.col(key).alias("id"),
        whole.alias("text"),
        h(0).alias("h1"),
        h(1).alias("h2"),
        (held | (h(2) % 100 >= rate)).alias("plain"),
        (h(3) % 100 < spm_rate).alias("spm"),
    )
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("fim_text", T.StringType()),
        ]
    )

    def run(batches):
        for batch in batches:
            for i, j in blocks(batch.column(1), BLOCK):
                b = batch.slice(i, j - i)
                h1, h2 = (c.to_numpy(zero_copy_only=False) for c in b.columns[2:4])
                plain, spm = (c.to_numpy(zero_copy_only=False) for c in b.columns[4:6])
                n, prefix, middle, out = _block(b.column(1), (h1, h2), plain, spm, unit)
                form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
                yield pa.record_batch(
                    [
                        b.column(0),
                        pa.array(n),
                        pa.array(form.tolist(), pa.string()),
                        pa.array(prefix, mask=plain),
                        pa.array(middle, mask=plain),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def restored_text(output, form):
    """Column: the document's text from its output and form.

    A transformed text holds no sentinel of its own, and no two sentinels or
    text borders can form one, so the output has each exactly once.
    """
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )


SQL = """
with d as (
  select doc_id, coalesce(text, '') as text,
    sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as units
  from documents
), n as (
  select *, len(units) as n,
    cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4
  from d
), p as (
  select *,
    array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') as prefix,
    array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1
                         :greatest(h1 % (n + 1), h2 % (n + 1))], '') as middle,
    array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') as suffix,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>')
           or contains(text, '<M>') or h3 % 100 >= 100 then 'plain'
         when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from n
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from p
"""


@register("op12_fill_in_middle", SQL)
def op12_fill_in_middle(spark, sf_dir):
    out = transform(read_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(restored_text(F.col("fim_text"), F.col("form")), 256).alias("restored_sha256"),
    )
