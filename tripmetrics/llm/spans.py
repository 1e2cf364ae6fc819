"""Places of regular-expression matches, in built-in functions and in time linear in the text.

A text may have very many matches. Appending to an array copies it, and a place deep in a text is
found by walking to it; so sums run in blocks, and texts are read by pieces of bounded length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as f

SPAN = "array<struct<start:int,end:int,value:string>>"
#: Elements whose running sums are appended to one array, and code points of a piece of text.
BLOCK = 256
PIECE = 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` loops over it."""
    return f.element_at(f.transform(f.array(value), body), 1)


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """States after each element: ``start`` and first element give the first state, and so on.

    ``step`` must be associative, as sums and maxima are. ``values`` should be bound by ``let``.
    """

    def states(block: Column, first: Column) -> Column:
        """``first``, then the state after each element."""
        return f.aggregate(
            block, f.array(first), lambda done, x: f.concat(done, f.array(step(f.get(done, f.size(done) - 1), x)))
        )

    def of_blocks(blocks: Column) -> Column:
        # each block alone, started with its own first element
        alone = f.transform(
            blocks,
            lambda b: f.aggregate(f.slice(b, 2, BLOCK), f.get(b, f.lit(0)), lambda x, y: step(x, y)),
        )
        return let(
            states(alone, start),
            lambda firsts: f.flatten(
                f.transform(
                    blocks, lambda b, i: f.slice(states(b, f.get(firsts, i)), 2, BLOCK)
                )
            ),
        )

    count = f.size(values)
    blocks = f.transform(
        f.sequence(f.lit(0), f.floor((count - 1) / BLOCK).cast("int")),
        lambda i: f.slice(values, i * BLOCK + 1, f.lit(BLOCK)),
    )
    return f.when(count == 0, f.transform(values, lambda _: start)).otherwise(let(blocks, of_blocks))


def running_sums(numbers: Column) -> Column:
    """Sums up to each element, itself included."""
    return let(numbers, lambda n: running(n, f.lit(0), lambda a, b: a + b))


def find(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches as an array of start, end (exclusive, in code points, from 0) and value.

    Splitting gives the gaps between the matches; places are the running sum of lengths. The
    pattern must not match the empty string. With ``group``, which must end where the match does,
    the spans are those of that group.
    """
    matched = lambda number: f.regexp_extract_all(text, f.lit(pattern), f.lit(number))
    columns = [f.split(text, pattern, -1).alias("gap"), matched(0).alias("whole")]
    found = f.arrays_zip(*columns, *([matched(group).alias("part")] if group else []))
    column = "part" if group else "whole"

    def placed(pairs: Column) -> Column:
        def span(end: Column, i: Column) -> Column:
            value = f.get(pairs, i)[column]
            return f.struct(
                (end - f.length(value)).alias("start"), end.alias("end"), value.alias("value")
            )

        lengths = f.transform(pairs, lambda p: f.length(p["gap"]) + f.length(p["whole"]))
        return f.transform(running_sums(lengths), span)

    # the gap after the last match has no match
    matches = let(found, lambda pairs: f.slice(pairs, 1, f.size(pairs) - 1))
    return let(matches, placed).cast(SPAN)


def none() -> Column:
    return f.array().cast(SPAN)


def pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, for ``between``; bind them by ``let``."""
    return f.regexp_extract_all(text, f.lit(f"(?s).{{1,{PIECE}}}"), f.lit(0))


def between(cut: Column, start: Column, end: Column) -> Column:
    """What stands from ``start`` to ``end`` (exclusive), from the pieces it touches alone."""
    places = f.struct(
        f.floor(start / PIECE).cast("int").alias("first"),
        f.floor(end / PIECE).cast("int").alias("last"),
        (start % PIECE).alias("begins"),
        (end % PIECE).alias("ends"),
    )

    def joined(p: Column) -> Column:
        one = f.substring(f.get(cut, p["first"]), p["begins"] + 1, p["ends"] - p["begins"])
        several = f.concat(
            f.substring(f.get(cut, p["first"]), p["begins"] + 1, f.lit(PIECE)),
            f.array_join(f.slice(cut, p["first"] + 2, p["last"] - p["first"] - 1), ""),
            f.coalesce(f.substring(f.get(cut, p["last"]), f.lit(1), p["ends"]), f.lit("")),
        )
        return f.coalesce(f.when(p["first"] == p["last"], one).otherwise(several), f.lit(""))

    return let(places, joined)


def covered(spans: Column, others: Column) -> Column:
    """For each of ``spans``, the characters it shares with each of ``others``, summed.

    Up to a place x, spans cover the sum of what they cover left of x; the difference at a span's ends
    is what it shares. Places are sorted once, so that no span is compared with all others.
    """

    def event(at: Column, change: Column | int, asked: Column | int) -> Column:
        return f.struct(
            at.cast("int").alias("at"),
            (change if isinstance(change, Column) else f.lit(change)).cast("int").alias("change"),
            (asked if isinstance(asked, Column) else f.lit(asked)).cast("int").alias("asked"),
        )

    def answered(events: Column) -> Column:
        def of_slopes(slopes: Column) -> Column:
            steps = f.transform(  # the last slope is none
                slopes,
                lambda slope, i: slope * f.coalesce(f.get(events, i + 1)["at"] - f.get(events, i)["at"], f.lit(0)),
            )
            return let(
                running_sums(steps),
                lambda sums: f.array_sort(
                    f.filter(
                        f.transform(
                            events,
                            lambda e, i: f.struct(
                                e["asked"].alias("asked"),
                                f.coalesce(f.get(sums, i - 1), f.lit(0)).alias("before"),
                            ),
                        ),
                        lambda row: row["asked"] >= 0,
                    )
                ),
            )

        slopes = running_sums(f.transform(events, lambda e: e["change"]))
        return let(slopes, of_slopes)

    asked = f.concat(
        f.transform(spans, lambda s, i: event(s["start"], 0, 2 * i)),
        f.transform(spans, lambda s, i: event(s["end"], 0, 2 * i + 1)),
        f.transform(others, lambda o: event(o["start"], 1, -1)),
        f.transform(others, lambda o: event(o["end"], -1, -1)),
    )
    return let(
        let(f.array_sort(asked), answered),
        lambda answers: f.transform(
            spans, lambda _, i: f.get(answers, 2 * i + 1)["before"] - f.get(answers, 2 * i)["before"]
        ),
    )


def distinct_sorted(spans: Column) -> Column:
    """Different elements in order; ``array_distinct`` compares structs with all others."""
    return let(
        f.array_sort(spans),
        lambda ordered: f.filter(
            ordered, lambda s, i: (i == 0) | ~s.eqNullSafe(f.get(ordered, i - 1))
        ),
    )


def digits(value: Column) -> Column:
    return f.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    place = f.sequence(f.lit(1), f.length(number))
    backwards = f.reverse(number)

    def share(i: Column) -> Column:
        doubled = f.substring(backwards, i, 1).cast("int") * (f.lit(2) - i % 2)
        return doubled - f.when(doubled > 9, 9).otherwise(0)

    return f.aggregate(f.transform(place, share), f.lit(0), lambda a, b: a + b) % 10 == 0
