"""Secret scans.

Three known forms are found by pattern.  Beyond them, candidate strings of each character
class are read through a sliding window whose Shannon entropy is kept up to date by the
counts of the one character that enters and the one that leaves; an allow-list suppresses
what only looks random, and no more than that: the rest of a candidate with filler in it, and
each segment of a path, is read alone.  DataFrame functions throughout, one scan, no shuffle.

Positions come from the pieces between matches, so they are in code points.  Defined
results: a null or empty text has no spans; texts of any length are scanned whole;
repeated rows are each reported; other columns are carried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import merged_spans, running, text_or_empty, whole_rows

# The forms of known secrets, in the order their kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings by character class, and the entropy in bits that a window must reach.
#: Runs of hexadecimal digits end at what is neither letter nor digit, or begin after 0x.
HEX_RUN = r"(?:(?<![A-Za-z0-9])|(?<=(?<![A-Za-z0-9])0[xX]))[0-9A-Fa-f-]{20,}(?![A-Za-z0-9])"
BASE64_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
HEX_ALPHABET = "0123456789abcdefABCDEF-"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Whole candidates that look random but are none: identifiers and the sample keys of manuals.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
    r"|^[A-Za-z0-9/+]{13,33}EXAMPLE(?:KEY)?$"
)
#: Filler, at which candidates are cut; what is left on either side is scanned.
FILLER = (
    r"(?i:example|sample|placeholder|changeme|dummy|lorem|x{4,}|0123456789"
    r"|abcdefgh(?:ijklmnop(?:qrstuvwxyz)?)?)"
)
#: Lower-case paths are cut at each slash too, and segments of plain words are allowed.
PATH = r"^(?=[^/]*/[^/]*/)[a-z0-9_/-]+$"
WORDS = r"^[a-z]*[0-9]*(?:[_-]+[a-z]*[0-9]*)*+$"

SPAN = "array<struct<start:int,kind:int,end:int>>"


def _nothing() -> Column:
    return F.array().cast(SPAN)


def _matches(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """``start, kind, end, value``: leftmost non-overlapping matches whose ``group`` has ``least`` characters."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), F.length).alias("gap"),
        found.alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    spans = running(
        F.transform(
            parts,
            lambda x: F.struct(
                (x["gap"] + F.length(x["match"])).alias("width"), x["gap"].alias("gap"), x["match"].alias("match"), x["value"].alias("value")
            ),
        ),
        F.lit(0),
        lambda at, x: at + x["width"],
        lambda at, x: F.struct(
            (at + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (at + x["width"]).alias("end"), x["match"].alias("match"), F.length(x["value"]).alias("size")
        ),
        "struct<start:int,kind:int,end:int,match:string,size:int>",
    )
    return F.filter(spans, lambda s: s["size"] >= least)


def _found(text: Column, pattern: str, kind: int, group: int = 0, least: int = 1) -> Column:
    spans = F.transform(
        _matches(text, pattern, kind, group, least),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    return F.when(text.rlike(pattern), spans).otherwise(_nothing())


def known_secrets(text: Column) -> Column:
    """Spans of the known forms by start, then kind.

    A run of hexadecimal digits is maximal, so asking for 32 of them in the pattern keeps the
    same matches as dropping shorter runs; likewise for the 12 characters after ``AKIA``.
    """
    hex_run = HEX.replace("+", "{32,}")
    access = ACCESS.replace("+", "{12,}")
    return F.array_sort(
        F.concat(
            _found(text, ASSIGN, 0, group=2, least=8),
            _found(text, access, 1),
            _found(text, hex_run, 2),
        )
    )


def _bits(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def entropy_span(value: Column, alphabet: str, window: int, bits: float) -> Column:
    """From the first to the last window of ``window`` characters with ``bits`` of entropy.

    The entropy is log2(window) - sum(c log2 c) / window over the counts c of the window.
    A step changes two counts, and the sum by their differences.  Null if no window
    reaches the bound.
    """
    chars = F.split(value, "")
    letters = F.lit(alphabet)
    zero = F.struct(
        F.lit(0).alias("i"),
        F.lit(0.0).alias("sum"),
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def step(acc, char):
        enters = F.instr(letters, char) - 1
        leaves = F.when(acc["i"] >= window, F.instr(letters, F.get(chars, acc["i"] - window)) - 1).otherwise(-1)
        up, down = F.get(acc["counts"], enters), F.get(acc["counts"], leaves)
        change = F.when(enters == leaves, 0.0).otherwise(
            F.coalesce(_bits(up + 1) - _bits(up), F.lit(0.0)) + F.coalesce(_bits(down - 1) - _bits(down), F.lit(0.0))
        )
        counts = F.transform(
            acc["counts"], lambda c, k: c + (k == enters).cast("int") - (k == leaves).cast("int")
        )
        full = acc["i"] >= window - 1
        hot = full & (math.log2(window) - (acc["sum"] + change) / window >= bits)
        return F.struct(
            (acc["i"] + 1).alias("i"),
            (acc["sum"] + change).alias("sum"),
            counts.alias("counts"),
            F.when(hot, F.coalesce(acc["first"], acc["i"] - (window - 1))).otherwise(acc["first"]).alias("first"),
            F.when(hot, acc["i"] + 1).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(
        chars,
        zero,
        step,
        lambda acc: F.when(acc["first"].isNotNull(), F.struct(acc["first"].alias("first"), acc["last"].alias("last"))),
    )


def _cut(value: Column, pattern: str) -> Column:
    """``start, value`` of the pieces between the matches."""
    parts = F.arrays_zip(
        F.split(value, pattern, -1).alias("gap"), F.regexp_extract_all(value, F.lit(pattern), F.lit(0)).alias("match")
    )
    widths = F.transform(
        parts,
        lambda x: F.struct(
            (F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))).alias("width"), x["gap"].alias("gap")
        ),
    )
    return running(
        widths,
        F.lit(0),
        lambda at, x: at + x["width"],
        lambda at, x: F.struct(at.alias("start"), x["gap"].alias("value")),
        "struct<start:int,value:string>",
    )


def _not_allowed(value: Column, window: int) -> Column:
    """``start, value`` of the pieces of a candidate that are to be scanned."""
    segments = F.filter(_cut(value, rf"/|{FILLER}"), lambda p: ~p["value"].rlike(WORDS))
    pieces = F.when(value.rlike(PATH), segments).otherwise(_cut(value, FILLER))
    return F.filter(pieces, lambda p: F.length(p["value"]) >= window)


def _random_runs(text: Column, pattern: str, alphabet: str, mixed: str, window: int, bits: float) -> Column:
    """Entropy spans of the candidates of one class, or pieces of them, that hold ``mixed`` and are not allowed."""
    whole = F.filter(
        F.transform(
            _matches(text, pattern, 3, 0, window),
            lambda s: F.struct(s["start"].alias("start"), s["match"].alias("value")),
        ),
        lambda c: c["value"].rlike(mixed) & ~c["value"].rlike(ALLOWED),
    )
    pieces = F.transform(
        whole,
        lambda c: F.transform(
            _not_allowed(c["value"], window),
            lambda p: F.struct((c["start"] + p["start"]).alias("start"), p["value"].alias("value")),
        ),
    )
    candidates = F.filter(F.flatten(pieces), lambda c: c["value"].rlike(mixed))
    spans = F.transform(
        candidates,
        lambda c: F.transform(
            F.array(entropy_span(c["value"], alphabet, window, bits)),
            lambda hot: F.struct(
                (c["start"] + hot["first"]).alias("start"),
                F.lit(3).alias("kind"),
                (c["start"] + hot["last"]).alias("end"),
            ),
        )[0],
    )
    return F.when(text.rlike(pattern), F.filter(spans, lambda s: s["start"].isNotNull())).otherwise(_nothing())


def _merged(spans: Column) -> Column:
    """Spans by start, those that overlap as one."""
    sorted_spans = F.transform(F.array_sort(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.transform(
        merged_spans(sorted_spans, touching=False),
        lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")),
    )


def random_strings(
    text: Column, window: int = 20, hex_bits: float = 3.0, base64_bits: float = 3.7
) -> Column:
    """Spans of high entropy.  Strings of the wider class must hold a letter and a digit.

    Hexadecimal runs may lie inside strings of the wider class; spans that overlap are one.
    """
    wide = r"^(?=.*[0-9])(?=.*[A-Za-z])(?=.*[^0-9A-Fa-f-])"
    return _merged(
        F.concat(
            _random_runs(text, HEX_RUN, HEX_ALPHABET, "[0-9].*[A-Fa-f]|[A-Fa-f].*[0-9]", window, hex_bits),
            _random_runs(text, BASE64_RUN, BASE64_ALPHABET, wide, window, base64_bits),
        )
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``known`` and ``random``: arrays of spans.

    A span of high entropy inside a known one is left out.
    """
    text = text_or_empty("text")
    known = docs.select(whole_rows(docs), known_secrets(text).alias("known"), random_strings(text).alias("random"))
    # A known span that begins no later holds a span if none of these ends before it does.
    marked = running(
        F.array_sort(F.concat("known", "random")),
        F.lit(-1),
        lambda at, s: F.when(s["kind"] < 3, F.greatest(at, s["end"])).otherwise(at),
        lambda at, s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), at.alias("before")),
        "struct<start:int,kind:int,end:int,before:int>",
    )
    outside = F.transform(
        F.filter(marked, lambda s: (s["kind"] == 3) & (s["before"] < s["end"])),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    return known.select("row", "known", F.when(F.size("random") > 0, outside).otherwise(F.col("random")).alias("random"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with ``mark`` for each maximal run of covered characters."""

    def step(acc, s):
        ahead = F.greatest(s["start"], acc["at"])
        kept = F.substring(text, acc["at"] + 1, ahead - acc["at"])
        apart = (ahead > acc["at"]) | (acc["at"] == 0)
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["out"], kept, F.when(apart, F.lit(mark)).otherwise(F.lit(""))).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.aggregate(F.array_sort(spans), zero, step, rest)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )
