"""Secret scans with multipart credential linking, in DataFrame expressions only.

Strong shapes (assigned values, access identifiers, long hex strings) are
reported alone.  Weak candidates (short values, short identifiers, short hex
strings, opaque keys, endpoints) are reported only when a complementary part
lies in the same scope: an access identifier or an endpoint completes a
secret, and a secret completes either.  The scope of a part is its interval
widened by ``scope`` characters; the parts of a text are sorted by start and
swept once in each direction, which joins every interval with the nearest
complementary one on each side without forming pairs.

Matches are found without offsets support in SQL by cutting the text at the
pattern: the pieces between the matches and the matches alternate, so their
running lengths are the offsets (in code points, end exclusive).  Kinds of one
shape share a pattern, which runs once over a text, and once more to cut texts
that match.  Walks over the matches go by blocks (``_gather``), so their work
grows with the matches, not with their square.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns.  Letters of the keywords match in either case.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

#: Weak shapes: an opaque key (letters of both cases and a digit are checked apart) and an endpoint.
OPAQUE = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+"
ENDPOINT = r"""(?i:https?|ftp|jdbc|postgresql|postgres|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]+"""

#: Code points between complementary parts.
SCOPE = 200


@dataclass(frozen=True)
class Kind:
    name: str
    role: str  # id, secret or endpoint
    strong: bool
    pattern: str  # what is looked for; equal patterns run once
    group: int  # the group whose length counts
    least: int
    below: int | None = None  # length from which a stronger kind takes over
    needs: tuple[str, ...] = ()  # patterns the match must contain as well


#: A hex run counts from 16 characters; the pattern asks for that many at once, which finds the same runs as
#: filtering all runs by length.
LONG_HEX = r"[0-9a-f]{16,}+"
#: In the order of listing.
KINDS = (
    Kind("assign", "secret", True, ASSIGN, 2, 6),
    Kind("access", "id", True, ACCESS, 0, 20),
    Kind("hex", "secret", True, LONG_HEX, 0, 24),
    Kind("weak_assign", "secret", False, ASSIGN, 2, 1, 6),
    Kind("weak_access", "id", False, ACCESS, 0, 5, 20),
    Kind("weak_hex", "secret", False, LONG_HEX, 0, 16, 24, ("[0-9]", "[a-f]")),
    Kind("opaque", "secret", False, OPAQUE, 0, 32, None, ("[0-9]", "[A-Z]", "[a-z]")),
    Kind("endpoint", "endpoint", False, ENDPOINT, 0, 1),
)
_PART = "struct<s:bigint,k:int,e:bigint>"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Elements that are walked with their results at hand.
BLOCK = 128


def _gather(walk: str, state: dict[str, tuple[str, str]], when: str, result: str, kind: str) -> str:
    """Walks over array ``walk`` (element ``x``, state ``a``) and returns the ``result`` of each element for which
    ``when`` holds, as ``array<kind>``.  ``state``: first value and next value, both bigint, by field.

    Spark copies the state at every step, so a state must not hold results.
    The array is cut into blocks: a first walk, block by block, keeps the
    numbers only and notes them where a block begins; then each block is
    walked by itself, with its own few results in the state."""
    numbers = ", ".join(f"'{f}', {{0}}.{f}" for f in state)
    step = ", ".join(f"'{f}', {v}" for f, (_, v) in state.items())
    first = ", ".join(f"'{f}', {v}" for f, (v, _) in state.items())
    kept = "struct<" + ",".join(f"{f}:bigint" for f in state) + ">"
    none = f"cast(array() as array<{kind}>)"
    part = f"slice(w, b * {BLOCK} + 1, {BLOCK})"
    begins = f"""aggregate(sequence(0, (size(w) - 1) div {BLOCK}),
        named_struct({first}, 'at_', cast(array() as array<{kept}>)),
        (o, b) -> transform(
            array(aggregate({part}, named_struct({numbers.format('o')}), (a, x) -> named_struct({step}))),
            e -> named_struct({numbers.format('e')}, 'at_', concat(o.at_, array(named_struct({numbers.format('o')})))))[0],
        o -> o.at_)"""
    block = f"""aggregate({part}, named_struct({numbers.format('s[b]')}, 'cur_', {none}),
        (a, x) -> named_struct({step}, 'cur_', if({when}, concat(a.cur_, array({result})), a.cur_)), a -> a.cur_)"""
    return (f"transform(array({walk}), w -> transform(array({begins}), s -> "
            f"flatten(transform(sequence(0, size(s) - 1), b -> {block})))[0])[0]")


def _patterns() -> dict[str, list[int]]:
    """The kinds of each pattern."""
    out: dict[str, list[int]] = {}
    for i, k in enumerate(KINDS):
        out.setdefault(k.pattern, []).append(i)
    return out


def _kind_of(numbers: list[int], pattern: str) -> str:
    """Which of these kinds a match ``x.m`` is, or null."""
    cases = ""
    for i in numbers:
        kind = KINDS[i]
        own = f"length(regexp_extract(x.m, {_quoted(pattern)}, {kind.group}))" if kind.group else "length(x.m)"
        ok = f"{own} >= {kind.least}"
        if kind.below is not None:
            ok += f" and {own} < {kind.below}"
        for need in kind.needs:
            ok += f" and x.m rlike {_quoted(need)}"
        cases += f" when {ok} then {i}"
    return f"case{cases} end"


def _spans(pattern: str, numbers: list[int], found: str) -> Column:
    """Spans of a pattern's kinds in ``_text``, in order, as ``array<struct<s, k, e>>``; ``found``: the matches."""
    # The last piece has no match behind it: it is left out.
    cut = f"""zip_with(slice(split(_text, {_quoted(pattern)}, -1), 1, size({found})), {found},
        (p, m) -> named_struct('p', length(p), 'm', m))"""
    kept = f"transform({cut}, x -> named_struct('p', x.p, 'n', length(x.m), 'k', {_kind_of(numbers, pattern)}))"
    walk = _gather(kept, {"at": ("0L", "a.at + x.p + x.n")}, "x.k is not null",
                   "named_struct('s', a.at + x.p, 'k', x.k, 'e', a.at + x.p + x.n)", _PART)
    return F.expr(f"if(size({found}) = 0, cast(array() as array<{_PART}>), {walk})")


_FAR = {"e": "-1000000000000L", "s": "1000000000000L"}
_STRONG = ", ".join(str(i) for i, k in enumerate(KINDS) if k.strong)
_WEAK = ", ".join(str(i) for i, k in enumerate(KINDS) if not k.strong)


def _uncovered(order: str, near: str) -> str:
    """Parts less the weak ones that overlap a base span met before, walking in one direction."""
    better, under = ("greatest", f"x.k in ({_WEAK}) and a.b > x.s") if near == "e" else (
        "least", f"x.k in ({_WEAK}) and a.b < x.e")
    return _gather(order, {"b": (_FAR[near], f"if(x.k in ({_STRONG}), {better}(a.b, x.{near}), a.b)")},
                   f"not ({under})", "x", _PART)


def _sweep(order: str, near: str) -> str:
    """Parts that have a complementary part on one side, walking in one direction.

    State: per role, the nearest border so far (largest end going forward,
    smallest start going back)."""
    better = "greatest" if near == "e" else "least"
    roles = {r: ", ".join(str(i) for i, k in enumerate(KINDS) if k.role == r) for r in ("id", "secret", "endpoint")}
    state = {r: (_FAR[near], f"if(x.k in ({ks}), {better}(a.{r}, x.{near}), a.{r})") for r, ks in roles.items()}
    gap = (lambda r: f"x.s - a.{r} <= scope_") if near == "e" else (lambda r: f"a.{r} - x.e <= scope_")
    hit = (f"case when x.k in ({roles['secret']}) then {gap('id')} or {gap('endpoint')} "
           f"else {gap('secret')} end")
    return _gather(order, state, hit, "x", _PART)


def find_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text",
                 keep: bool = False) -> DataFrame:
    """``(doc_id, base, added)`` per row: arrays of ``struct<s, k, e>`` spans.

    ``k`` is the place in ``KINDS``.  ``base`` has the strong spans, ``added``
    the weak ones that a complementary part completes and that no base span
    overlaps.  Null texts count as empty; null or repeated ids and repeated
    rows are passed through; an empty table gives an empty result; extra
    columns are ignored, or kept under ``row`` with ``keep``.
    """
    first = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep else []
    df = docs.select(*first, F.col(f"`{id_col}`").alias("_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    patterns = list(_patterns().items())
    df = df.withColumns({f"_m{j}": F.expr(f"regexp_extract_all(_text, {_quoted(p)}, 0)") for j, (p, _) in enumerate(patterns)})
    df = df.withColumns({f"_s{j}": _spans(p, kinds, f"_m{j}") for j, (p, kinds) in enumerate(patterns)})
    every = ", ".join(f"_s{j}" for j in range(len(patterns)))
    df = df.withColumn("_all", F.expr(f"array_sort(concat({every}))"))
    df = df.withColumn("_base", F.expr(f"filter(_all, x -> x.k in ({_STRONG}))"))
    # Weak parts that overlap a base span are the same find: only the others take part.
    df = df.withColumn("_parts", F.expr(f"if(size(_all) = size(_base), cast(array() as array<{_PART}>), "
                                        f"{_uncovered('_all', 'e')})"))
    df = df.withColumn("_parts", F.expr(f"if(size(_parts) < 2, _parts, reverse({_uncovered('reverse(_parts)', 's')}))"))
    back, ahead = _sweep("_parts", "e"), _sweep("reverse(_parts)", "s")
    linked = (f"array_sort(filter(array_distinct(concat({back}, {ahead})), x -> x.k in ({_WEAK})))"
              .replace("scope_", str(int(scope))))
    df = df.withColumn("_added", F.expr(f"if(size(_parts) < 2, cast(array() as array<{_PART}>), {linked})"))
    out = [F.col("row"), F.col("_text")] if keep else []
    return df.select(*out, F.col("_id").alias(id_col), F.col("_base").alias("base"), F.col("_added").alias("added"))


def _listed(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k.name}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', {names}[x.k], x.s, x.e)), ',')")


def secret_report(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans as text.

    Null and empty texts have none (zeros, the digest of nothing, an empty
    string); ids may be null or repeated; repeated rows are returned as often
    as they came; an empty table gives an empty result; extra columns are
    ignored.
    """
    found = find_secrets(docs, scope, id_col, text_col)
    count = lambda i: F.expr(f"cast(size(filter(base, x -> x.k = {i})) as bigint)")
    return found.select(
        id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("array_sort(concat(base, added))").alias("spans"),
        F.expr("cast(size(added) as bigint)").alias("n_linked"))


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE, id_col: str = "doc_id",
                   text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` (overlapping spans by one).

    Rows without a span stay as they are (a null text stays null); the column
    ``length_col``, if there is one, follows the new length of a changed text.
    """
    found = find_secrets(docs, scope, id_col, text_col, keep=True)
    spans = "array_sort(concat(base, added))"
    # The stretches (f, t) before each mark; overlapping spans share one.
    keeps = _gather(spans, {"at": ("0L", "greatest(a.at, x.e)")}, "x.s >= a.at", "named_struct('f', a.at, 't', x.s)",
                    "struct<f:bigint,t:bigint>")
    found = found.withColumn("_keeps", F.expr(keeps))
    # A substring is found by counting from the front, so a piece of stretches is cut out first.
    first = f"_keeps[b * {BLOCK}].f"
    piece = (f"substring(_text, cast({first} + 1 as int), "
             f"cast(_keeps[least(size(_keeps), (b + 1) * {BLOCK}) - 1].t - {first} as int))")
    text = F.expr(f"""concat(
        array_join(transform(sequence(0, (size(_keeps) - 1) div {BLOCK}), b -> transform(array({piece}), g ->
            array_join(transform(slice(_keeps, b * {BLOCK} + 1, {BLOCK}),
                k -> concat(substring(g, cast(k.f - {first} + 1 as int), cast(k.t - k.f as int)), {_quoted(mark)})),
                ''))[0]), ''),
        substring(_text, cast(array_max(transform({spans}, x -> x.e)) + 1 as int)))""")
    found = found.withColumn("_new", F.when(F.expr("size(base) + size(added) > 0"), text))
    cols = []
    for c in docs.columns:
        old = F.col(f"row.`{c}`")
        if c == text_col:
            old = F.coalesce("_new", old)
        elif c == length_col:
            old = F.when(F.col("_new").isNotNull(), F.length("_new").cast(docs.schema[c].dataType)).otherwise(old)
        cols.append(old.alias(c))
    return found.select(*cols)
