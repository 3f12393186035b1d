"""Lines of a document as Catalyst expressions; every function takes and returns Columns. Null text gives null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line separators of universal newlines, and white space, as regular expressions for Java and RE2 alike.
UNIVERSAL = r"\r\n|[\n\x{0B}\x{0C}\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
SPACE = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once. An expression used inside a lambda is otherwise evaluated again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Both ends freed of Unicode white space."""
    return F.regexp_replace(F.regexp_replace(text, f"^{SPACE}+", ""), f"{SPACE}+$", "")


def split_lines(text: Column) -> Column:
    """Split at "\\n" only: a trailing newline gives an empty last line, an empty text one empty line."""
    return F.split(text, "\n", -1)


def split_universal(text: Column) -> Column:
    """Split at every universal newline; no empty last line, an empty text has no lines."""
    parts = F.split(text, UNIVERSAL, -1)
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def split_stripped(text: Column) -> Column:
    return split_lines(strip(text))


def join_lines(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def even_batches(values: Column, size: int) -> Column:
    """Contiguous batches of at most ``size``, as even as can be; the first ones take one more. Empty gives no batch."""

    def cut(v: Column) -> Column:
        n, k = v["n"], v["k"]
        short, longer = F.floor(n / k).cast("int"), F.pmod(n, k)
        batch = lambda i: F.slice(v["v"], i * short + F.least(i, longer) + 1, short + F.when(i < longer, 1).otherwise(0))
        return F.when(n == 0, F.slice(F.array(v["v"]), 1, 0)).otherwise(F.transform(F.sequence(F.lit(0), k - 1), batch))

    sized = let(values, lambda v: F.struct(v.alias("v"), F.size(v).alias("n"), F.ceil(F.size(v) / F.lit(size)).cast("int").alias("k")))
    return F.when(values.isNotNull(), let(sized, cut))


def segments(line: Column, limit: int = 200) -> Column:
    """Sentences packed greedily into pieces, each sentence counted with the space before it.

    A piece closes when the next sentence would pass the limit, so a first sentence of that length leaves an empty piece before it;
    a longer sentence stands alone and is never cut. Pieces come out stripped; an empty text gives one empty piece.
    """
    sentences = F.split(line, rf"(?<=[.!?]){SPACE}+", -1)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(state: Column, sentence: Column) -> Column:
        fits = F.length(state["open"]) + F.length(sentence) + 1 <= limit
        return F.struct(
            F.when(fits, state["done"]).otherwise(F.concat(state["done"], F.array(strip(state["open"])))).alias("done"),
            F.when(fits, F.concat(state["open"], F.lit(" "), sentence)).otherwise(sentence).alias("open"),
        )

    return F.aggregate(sentences, start, add, lambda s: F.when(s["open"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(strip(s["open"])))))


def numbered(lines: Column) -> Column:
    """Lines rendered for a prompt: ``Line i: ...`` each followed by a rule."""
    return F.array_join(F.transform(lines, lambda x, i: F.concat(F.lit("Line "), (i + 1).cast("string"), F.lit(": "), x, F.lit("\n------\n"))), "")


def argmax(names: Column, weights: Column) -> Column:
    """The name of the highest weight, the first of equals; null for null or empty arrays."""
    at = F.array_position(weights, F.array_max(weights)).cast("int")
    return F.get(names, at - 1)


def score_list(rendered: Column) -> Column:
    """A rendered list of numbers (brackets or parentheses, None for null, outer blanks) as array<double>; null when malformed."""
    text = F.regexp_replace(strip(rendered), r"^\(([^()]*?),?\s*\)$", "[$1]")
    text = F.regexp_replace(text, r"\bNone\b", "null")
    well = text.rlike(r"^\[\s*(?:(?:-?[0-9.]+(?:[eE][-+]?[0-9]+)?|null)\s*(?:,\s*(?:-?[0-9.]+(?:[eE][-+]?[0-9]+)?|null)\s*)*)?\]$")
    return F.when(well, F.from_json(text, "array<double>"))


def model_text(output: Column) -> Column:
    """Model output freed at both ends of back quotes, spaces, newlines and the letters j, s, o, n."""
    return F.regexp_replace(F.regexp_replace(output, "^[ `\njson]+", ""), "[ `\njson]+$", "")


def well_formed(output: Column) -> Column:
    """Whether every line of the output reads ``Line i: ...`` with i from 1 to 29."""
    return F.forall(split_lines(output), lambda x: x.rlike("^Line ([1-9]|1[0-9]|2[0-9]):.+"))


def label_after_colon(line: Column) -> Column:
    """What stands between the first and second colon, trimmed, in lower case; null without a colon."""
    return F.lower(strip(F.get(F.split(line, ":", -1), F.lit(1))))
