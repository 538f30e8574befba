"""Secret scans, with DataFrame functions only.

Base kinds are patterns (assignments to secret names, access key ids, long hex strings). Added are
high-entropy strings: over every candidate string a window of WINDOW characters slides; its Shannon
entropy is kept up to date from incremental counts (one character enters, one leaves, and the sum of
c * log2(c) changes in two terms). Each character class (hex, base64-like) has its own limit. Strings
on the allow-list are suppressed.

Candidates are runs of signs in the text after what the base patterns match is blanked: first all
assignments (also those too short to be reported), then access keys, then hex strings. What is left
of a string beside them is scored by itself, without =, _, + and - at its edges. Base spans always
stay.

Offsets are code points, ends exclusive; they are running sums of the lengths of matches and of what
lies between them, taken in blocks. All work is linear in a text's length: no pattern repeats a group
without being possessive (Java's stack would grow with the text), nothing is compared pair by pair,
and long candidates are scored in parts of PART characters, until one is found to be a secret.

Nulls and empty texts have no spans. Very long texts are scanned whole. Repeated rows each get their
row; a null doc_id is kept; extra columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text

#: The patterns of the base kinds, and the least length of what each must hold.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
SIGN = "[A-Za-z0-9+/_=-]"
#: Runs of WINDOW signs or more; a run is tried at its start only.
CANDIDATE = rf"(?<!{SIGN}){SIGN}{{{WINDOW},}}+"
#: Characters of a candidate whose windows are scored in one go, and of an array whose sums are run at once.
PART, BLOCK = 1024, 64
#: What a candidate may begin and end with that is no part of a value.
EDGE = "=_+-"
#: Least entropy in bits a character, of the best window, by character class.
HEX_LIMIT, BASE64_LIMIT = 3.0, 3.6
#: Words of paths and identifiers: in one case, capitalised or in camel case, with up to four digits at the end.
WORD = r"(?:[A-Z]?[a-z]++(?:[A-Z][a-z]{2,}+)*+[0-9]{0,4}+|[A-Z]++[0-9]{0,4}+|[0-9]{1,4}+)"
#: Never reported as entropy: identifiers, paths of words and placeholders rather than secrets.
ALLOWED = rf"^[/+_=-]*+(?:{WORD}[/+_=-]++)*+{WORD}?+$|" + r"^[0-9]+$|^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}+[0-9a-fA-F]{12}$|(?i:example|sample|dummy|placeholder|changeme|abcdefgh|12345678)|^(?:[A-Za-z]++[/_=-])++[A-Za-z]*+[0-9]{1,4}$"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once: inside a lambda an expression would be evaluated for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, levels: int = 3) -> Column:
    """Sums up to and with each value, in blocks of BLOCK: appending to one array would copy it at every step."""

    def plain(x: Column) -> Column:
        sums = F.aggregate(x, F.expr("cast(array() as array<int>)"), lambda done, v: F.concat(done, F.array(v + F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)))))
        return sums

    if levels == 1:
        return plain(values)

    def by_blocks(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda k: plain(F.slice(x, k * BLOCK + 1, F.lit(BLOCK))))

        def moved(inner: Column) -> Column:
            totals = running(F.transform(inner, lambda b: F.get(b, F.size(b) - 1)), levels - 1)
            before = F.concat(F.array(F.lit(0)), totals)
            return F.flatten(F.zip_with(inner, F.slice(before, F.lit(1), F.size(inner)), lambda b, at: F.transform(b, lambda v: v + at)))

        return let(blocks, moved)

    return F.when(F.size(values) <= BLOCK, plain(values)).otherwise(let(values, by_blocks))


def may_hold(text: Column, pattern: str) -> Column:
    """Whether text matches, with a search for plain words first where the pattern needs one."""
    needs = {ASSIGN: ("password", "passwd", "secret", "token", "api"), ACCESS: ("akia",)}.get(pattern)
    like = F.regexp_like(text, F.lit(pattern))
    if not needs:
        return like
    some = let(F.lower(text), lambda x: reduce(lambda a, b: a | b, (x.contains(w) for w in needs)))
    return F.when(some, like).otherwise(False)


def located(text: Column, pattern: str, keep=None, guard: Column | None = None) -> Column:
    """array<struct<start,end,match>> of the leftmost, non-overlapping matches that keep holds for; guard: whether there are any."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # One gap more than there are matches: the last step has no match.
    steps = F.zip_with(F.split(text, pattern, -1), found, lambda gap, x: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(x), F.lit(0)).alias("n"), x.alias("match")))

    def placed(x: Column) -> Column:
        ends = running(F.transform(x, lambda y: y["gap"] + y["n"]))
        return F.zip_with(x, ends, lambda y, end: F.struct((end - y["n"]).alias("start"), end.alias("end"), y["match"].alias("match")))

    spans = F.filter(let(steps, placed), lambda x: x["match"].isNotNull() & (keep(x) if keep else F.lit(True)))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,match:string>>)")
    return F.when(may_hold(text, pattern) if guard is None else guard, spans).otherwise(empty)


def blanked(text: Column, pattern: str, guard: Column) -> Column:
    """text with spaces in place of what matches; guard: whether anything may."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(F.split(text, pattern, -1), found, lambda gap, x: F.concat(gap, F.repeat(F.lit(" "), F.coalesce(F.length(x), F.lit(0)))))
    return F.when(guard, F.array_join(pieces, "")).otherwise(text)


def window_entropy(s: Column) -> Column:
    """The highest entropy of any WINDOW characters in a row of s, by incremental counts.

    The counts are a string with a letter for each sign of the alphabet (A: none), so that a step
    replaces two letters. The window begins as WINDOW blanks, a sign of its own; it counts once they have left.
    """
    terms = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)))
    signs = F.lit(" " + ALPHABET)
    # From the second letter: the first is of the blank.
    count_of = lambda counts, at: F.ascii(F.substring(counts, at, F.lit(1))) - ord("A")
    letter = lambda n: F.char(n + ord("A"))

    def step(acc: Column, x: Column) -> Column:
        gone = F.left(acc["window"], F.lit(1))
        into, out = F.instr(signs, x), F.instr(signs, gone)
        n_in, n_out = count_of(acc["counts"], into), count_of(acc["counts"], out)
        same = x == gone
        change = F.get(terms, n_in + 1) - F.get(terms, n_in) + F.get(terms, n_out - 1) - F.get(terms, n_out)
        window = F.concat(F.substring(acc["window"], F.lit(2), F.lit(WINDOW - 1)), x)
        return F.struct(
            window.alias("window"),
            F.when(same, acc["counts"]).otherwise(F.overlay(F.overlay(acc["counts"], letter(n_out - 1), out), letter(n_in + 1), into)).alias("counts"),
            F.when(same, acc["total"]).otherwise(acc["total"] + change).alias("total"),
            F.when(F.left(acc["window"], F.lit(2)).startswith("  "), acc["best"]).otherwise(F.least(acc["best"], F.when(same, acc["total"]).otherwise(acc["total"] + change))).alias("best"),
        )

    most = WINDOW * math.log2(WINDOW)
    zero = F.struct(F.lit(" " * WINDOW).alias("window"), F.lit(chr(ord("A") + WINDOW) + "A" * len(ALPHABET)).alias("counts"), F.lit(most).alias("total"), F.lit(most).alias("best"))
    chars = F.filter(F.split(s, "", -1), lambda c: c != "")
    return F.aggregate(chars, zero, step, lambda acc: math.log2(WINDOW) - acc["best"] / WINDOW)


def parts_of(s: Column) -> Column:
    """s in parts whose windows are all windows of s: each goes on into the next."""
    whole = F.regexp_extract_all(s, F.lit(f".{{1,{PART}}}"), F.lit(0))
    joined = let(whole, lambda x: F.zip_with(x, F.slice(x, F.lit(2), F.size(x)), lambda a, b: F.concat(a, F.left(F.coalesce(b, F.lit("")), F.lit(WINDOW - 1)))))
    return F.when(F.length(s) <= PART, F.array(s)).otherwise(joined)


def is_secret(s: Column) -> Column:
    limit = F.when(F.regexp_like(s, F.lit("^[0-9a-fA-F]+$")), HEX_LIMIT).otherwise(BASE64_LIMIT)
    mixed = F.regexp_like(s, F.lit("[A-Za-z]")) & ~F.regexp_like(s, F.lit(ALLOWED))
    return F.when(mixed, F.exists(parts_of(s), lambda part: window_entropy(part) >= limit)).otherwise(False)


def stripped(x: Column) -> Column:
    """A candidate without signs at its edges that belong to no value."""
    start = x["start"] + F.length(x["match"]) - F.length(F.ltrim(x["match"], F.lit(EDGE)))
    inner = F.trim(x["match"], F.lit(EDGE))
    return F.struct(start.alias("start"), (start + F.length(inner)).alias("end"), inner.alias("match"))


def tag(kind: str) -> Column:
    """The spans of a kind with what they sort by and how they are written."""
    return F.transform(kind, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), F.concat_ws(":", F.lit(kind), x["start"], x["end"]).alias("span")))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """A row for every document: counts and digest of base spans, all spans, n_entropy."""
    text, base = F.col("text"), {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    rest = id_text(docs).select("*", text.alias("rest"), *(may_hold(text, pattern).alias(f"has_{kind}") for kind, pattern in base.items()))
    for kind, pattern in base.items():
        rest = rest.withColumn("rest", blanked(F.col("rest"), pattern, F.col(f"has_{kind}")))
    long_value = lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= 12
    found = rest.select(
        "doc_id",
        *(located(text, pattern, long_value if kind == "assign" else None, F.col(f"has_{kind}")).alias(kind) for kind, pattern in base.items()),
        F.filter(F.transform(located(F.col("rest"), CANDIDATE), stripped), lambda x: F.length(x["match"]) >= WINDOW).alias("candidates"),
    )
    free = found.withColumn("entropy", F.filter("candidates", lambda c: is_secret(c["match"])))
    tagged = {kind: tag(kind) for kind in KINDS}
    joined = lambda *kinds: F.array_join(F.transform(F.array_sort(F.concat(*(tagged[k] for k in kinds))), lambda x: x["span"]), ",")
    return free.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(*KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        joined(*KINDS).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )
