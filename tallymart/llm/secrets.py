"""Secret scans with multipart credential linking.

Strong patterns stand for themselves.  Weak ones - account names, opaque values,
endpoints - are reported only where the parts of a credential meet: an interval
join of access identifiers, secrets and endpoints that lie within ``REACH`` code
points of each other.  Strong finds count as parts, too.  With ALL_ROLES all three
roles have to meet, from start to start.  With PAIRS two parts that complement each
other are enough (see ``_complemented``), from the end of one to the start of the
other, so a long part pushes no neighbour away; parts that overlap never complement
each other, and an ordinary link is no credential: neither with a number or name that
stands in its own path nor with a hash or an account beside it.

Everything is a projection of the row: matches and the text between them give
the offsets, and the join sweeps the row's own sorted parts, once forwards and once
backwards, with the nearest part of each role.  Patterns run on texts that can match, by a
cheaper test first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import filled, indexes

REACH = 200
IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"
ROLES = (IDENTIFIER, SECRET, ENDPOINT)


@dataclass(frozen=True)
class Kind:
    """A pattern, its role in a credential, and the least length of its ``group``."""

    name: str
    role: str
    pattern: str
    least: int
    group: int = 0


@dataclass(frozen=True)
class Linking:
    """How the parts of a credential meet: in ``pairs``, or all roles from start to start."""

    pairs: bool = False


ALL_ROLES, PAIRS = Linking(), Linking(True)

#: Names may have a prefix, as in DB_HOST.
_NAME = r"(?<![A-Za-z0-9])"
_SET = r"""["']?\x20*[:=]\x20*["']?"""
BASE = (
    Kind(
        "assign", SECRET,
        rf"(?i)(password|passwd|secret|token|api_?key){_SET}([A-Za-z0-9+/_.=-]+)", 6, 2,
    ),
    Kind("access", IDENTIFIER, r"AKIA[A-Z0-9]+", 20),
    Kind("hex", SECRET, r"[0-9a-f]+", 24),
)
WEAK = (
    Kind(
        "account", IDENTIFIER,
        rf"(?i){_NAME}(user(?:name)?|login|account|client_?id|access_?id){_SET}([A-Za-z0-9@+/_.=-]+)",
        3, 2,
    ),
    Kind(  # api_key is an assign
        "value", SECRET,
        rf"(?i){_NAME}(?<!api_)(pwd|pass|key|auth|credential|sig){_SET}([A-Za-z0-9+/_.=-]+)", 6, 2,
    ),
    Kind(
        "opaque", SECRET,
        # From the start of a run to its end, each character read a few times at most.
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9a-z+/_-]*+[A-Z])"
        r"(?=[0-9A-Z+/_-]*+[a-z])[A-Za-z0-9+/_-]{16,}+", 16,
    ),
    Kind("endpoint", ENDPOINT, r"(?i)\b[a-z][a-z0-9+]*://[^\x20\x09-\x0D\"'<>]+", 8),
    Kind("host", ENDPOINT, rf"(?i){_NAME}(host|endpoint|server|url){_SET}([A-Za-z0-9:/_.-]+)", 4, 2),
)
KINDS = BASE + WEAK

#: What a part can stand for in a pair, as bits.  A secret is named, with or without a digit in it,
#: or bare, a value that nothing names; an endpoint is a named host or a link.
_ID, _NAMED, _PLAIN, _BARE, _HOST, _LINK = (1 << k for k in range(6))
_CLASSES = (_ID, _NAMED, _PLAIN, _BARE, _HOST, _LINK)
_BARE_KINDS = ("hex", "opaque")
#: A link that is a credential by itself: a password in its user information, or a named secret as a query value.
_LOADED = (
    r"(?i)://[^/?#@]*:[^/?#@]+@"
    r"|[?&#;](?:[^=&;]*[_.-])?(?:pwd|passw(?:or)?d|secret|token|api_?key|access_?key|auth|credential|sig(?:nature)?)"
    r"=(?=[^&;]{0,500}[0-9])[^&;]{6,}"
)
#: A named address that is an ordinary link.
_NAMED_LINK = rf"(?i){_SET}https?://"
#: A named host that looks like an address.
_ADDRESS = rf"(?i){_SET}[A-Za-z0-9_-]*[.:/0-9]"

# A hex run is taken whole wherever it is long enough, so the short runs of
# ordinary words need not be listed and dropped.
_FAST = {"hex": r"[0-9a-f]{24,}", "access": r"AKIA[A-Z0-9]{16,}"}

_KEYS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "account": ("user", "login", "account", "client", "access"),
    "value": ("pwd", "pass", "key", "auth", "credential", "sig"),
}


def _possible(kind: Kind) -> Column:
    """A test that no text with a match fails."""
    text, low = F.col("_text"), F.col("_low")
    sets = F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))
    if kind.name in _KEYS:
        named = F.lit(False)
        for key in _KEYS[kind.name]:
            named = named | F.contains(low, F.lit(key))
        return sets & named
    if kind.name == "access":
        return F.contains(text, F.lit("AKIA"))
    if kind.name == "hex":
        return text.rlike(_FAST["hex"])
    if kind.name == "endpoint":
        return F.contains(text, F.lit("://"))
    if kind.name == "host":
        return sets & text.rlike(rf"(?i){_NAME}(host|endpoint|server|url){_SET}")
    return F.lit(True)


def _found(df: DataFrame, kind: Kind, where: Column) -> DataFrame:
    """Adds the array ``_spans_<kind>`` of (start, rank, end, kind, role), code points, end exclusive."""
    pattern = _FAST.get(kind.name, kind.pattern)
    text = F.col("_text")
    df = df.withColumn("_hits", F.when(where, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn("_gaps", F.when(F.size("_hits") > 0, F.split(text, pattern, -1)))
    spot = lambda start, hit: F.struct(
        start.alias("start"),
        F.lit(KINDS.index(kind)).alias("rank"),
        (start + F.char_length(hit)).alias("end"),
        F.lit(kind.name).alias("kind"),
        F.lit(kind.role).alias("role"),
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,role:string>>")

    def step(done: Column, i: Column) -> Column:
        hit = F.get(F.col("_hits"), i)
        start = done["at"] + F.char_length(F.get(F.col("_gaps"), i))
        long_enough = (
            F.char_length(F.regexp_extract(hit, kind.pattern, kind.group)) >= kind.least
            if kind.group
            else F.char_length(hit) >= kind.least
        )
        spans = F.when(long_enough, F.array_append(done["spans"], spot(start, hit)))
        return F.struct(
            (start + F.char_length(hit)).alias("at"), spans.otherwise(done["spans"]).alias("spans")
        )

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    spans = F.aggregate(indexes(F.size("_hits")), start, step, lambda done: done["spans"])
    return df.withColumn(
        f"_spans_{kind.name}", F.when(F.size("_hits") > 0, spans).otherwise(none)
    ).drop("_hits", "_gaps")


def with_spans(df: DataFrame, linking: Linking = ALL_ROLES) -> DataFrame:
    """Adds ``_base`` and ``_all``, the sorted strong spans and those with the linked weak ones.

    ``df`` has the text, not null, in ``_text``.
    """
    df = df.withColumn("_low", F.lower("_text"))
    others = [kind for kind in WEAK if kind.role != SECRET]
    for kind in (*BASE, *others):
        df = _found(df, kind, _possible(kind))
    # Secrets alone are of one role and link nothing, so weak ones need not be sought there.
    met = [F.size(f"_spans_{k.name}") for k in KINDS if k.role != SECRET]
    df = df.withColumn("_linkable", sum(met, F.lit(0)) > 0)
    for kind in WEAK:
        if kind not in others:
            df = _found(df, kind, F.col("_linkable") & _possible(kind))
    of = lambda kinds: F.concat(*(F.col(f"_spans_{k.name}") for k in kinds))
    df = df.withColumn("_base", F.sort_array(of(BASE)))
    linkable = F.col("_linkable")
    df = df.withColumn("_parts", F.when(linkable, F.sort_array(of(KINDS))))
    if linking.pairs:
        df = df.withColumn("_stand", F.when(linkable, _classes(F.col("_parts"))))
        df = df.withColumn("_edges", F.when(linkable, _edges(F.col("_parts"), F.col("_stand"))))
        df = df.withColumn("_before", F.when(linkable, _near(F.col("_edges"), False)))
        df = df.withColumn("_behind", F.when(linkable, _near(F.col("_edges"), True)))
        df = df.withColumn("_linked", F.when(linkable, _complemented()))
    else:
        df = df.withColumn("_before", F.when(linkable, _met(F.col("_parts"), False)))
        df = df.withColumn("_behind", F.when(linkable, _met(F.col("_parts"), True)))
        df = df.withColumn("_linked", F.when(linkable, _linked()))
    none = F.slice("_base", 1, 0)
    df = df.withColumn("_all", F.sort_array(F.concat("_base", F.coalesce("_linked", none))))
    return df.drop(
        "_low", "_linkable", "_parts", "_stand", "_edges", "_before", "_behind", "_linked",
        *(f"_spans_{k.name}" for k in KINDS),
    )


def _met(parts: Column, back: bool) -> Column:
    """For each part in the order of the sweep, the roles met so far as bits, its own included."""
    far = F.lit(1 << 30) if back else F.lit(-(1 << 30))

    def step(done: Column, own: Column) -> Column:
        bits, at = F.lit(0), []
        for k, role in enumerate(ROLES):
            mine, held = own["role"] == role, done[role]
            near = held <= own["start"] + REACH if back else held >= own["start"] - REACH
            bits = bits + F.when(mine | near, 1 << k).otherwise(0)
            at.append(F.when(mine, own["start"]).otherwise(held).alias(role))
        return F.struct(*at, F.array_append(done["bits"], bits).alias("bits"))

    start = F.struct(*(far.alias(role) for role in ROLES), F.array().cast("array<int>").alias("bits"))
    return F.aggregate(F.reverse(parts) if back else parts, start, step, lambda done: done["bits"])


def _linked() -> Column:
    """The weak parts that have parts of all roles within reach."""
    parts, n = F.col("_parts"), F.size("_parts")

    def meets(i: Column) -> Column:
        bits = F.get(F.col("_before"), i).bitwiseOR(F.get(F.col("_behind"), n - 1 - i))
        weak = F.get(parts, i)["rank"] >= len(BASE)
        return weak & (F.bit_count(bits) == len(ROLES))

    return F.transform(F.filter(indexes(n), meets), lambda i: F.get(parts, i))


def _classes(parts: Column) -> Column:
    """What each part stands for in a pair, one of ``_CLASSES``, or 0 for nothing.

    A part inside a link is none of its own: a bare value there counts only after an equals
    sign, as a query value, and a named secret counts as a bare one.
    """
    body = F.col("_text")

    def of(own: Column, until: Column) -> Column:
        inside = own["start"] < until
        shown = F.substring(body, own["start"] + 1, own["end"] - own["start"])
        named = F.when(inside, _BARE).when(shown.rlike("[0-9]"), _NAMED).otherwise(_PLAIN)
        bare = F.when(inside & (F.substring(body, own["start"], F.lit(1)) != "="), 0).otherwise(_BARE)
        return (
            F.when(own["role"] == IDENTIFIER, _ID)
            .when(own["kind"].isin(*_BARE_KINDS), bare)
            .when(own["role"] == SECRET, named)
            .when((own["kind"] == "endpoint") | shown.rlike(_NAMED_LINK), _LINK)
            .when(shown.rlike(_ADDRESS), _HOST)
            .otherwise(0)
        )

    def step(done: Column, own: Column) -> Column:
        link = own["kind"] == "endpoint"
        return F.struct(
            F.when(link, F.greatest(done["until"], own["end"])).otherwise(done["until"]).alias("until"),
            F.array_append(done["out"], of(own, done["until"])).alias("out"),
        )

    start = F.struct(F.lit(0).alias("until"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(parts, start, step, lambda done: done["out"])


def _edges(parts: Column, stand: Column) -> Column:
    """Ends (side 0) and starts (side 1) of all parts in order: (at, side, i, stand)."""
    at = lambda side, name: F.transform(
        indexes(F.size(parts)),
        lambda i: F.struct(
            F.get(parts, i)[name].alias("at"), F.lit(side).alias("side"), i.alias("i"),
            F.get(stand, i).alias("stand"),
        ),
    )
    return F.sort_array(F.concat(at(0, "end"), at(1, "start")))


def _near(edges: Column, back: bool) -> Column:
    """For each part, by number, the classes of the parts wholly before (behind) it within reach, as bits.

    The sweep keeps the nearest end (start) of each class; an end counts before a start at
    the same place, so parts that touch are near and parts that overlap are not.
    """
    far = F.lit(1 << 30) if back else F.lit(-(1 << 30))
    kept, asks = (1, 0) if back else (0, 1)

    def step(done: Column, edge: Column) -> Column:
        at, bits = [], F.lit(0)
        for stand in _CLASSES:
            held = done[f"c{stand}"]
            near = held <= edge["at"] + REACH if back else held >= edge["at"] - REACH
            bits = bits + F.when(near, stand).otherwise(0)
            mine = (edge["side"] == kept) & (edge["stand"] == stand)
            at.append(F.when(mine, edge["at"]).otherwise(held).alias(f"c{stand}"))
        told = F.array_append(done["out"], F.struct(edge["i"].alias("i"), bits.alias("bits")))
        return F.struct(*at, F.when(edge["side"] == asks, told).otherwise(done["out"]).alias("out"))

    start = F.struct(
        *(far.alias(f"c{stand}") for stand in _CLASSES),
        F.array().cast("array<struct<i:int,bits:int>>").alias("out"),
    )
    told = F.aggregate(F.reverse(edges) if back else edges, start, step, lambda done: done["out"])
    return F.transform(F.sort_array(told), lambda t: t["bits"])


def _complemented() -> Column:
    """The weak parts that are half of a credential.

    An identifier goes with any secret; a named secret with an identifier, a named host or,
    if it has a digit, a link; a bare one with an identifier.  An endpoint goes with a
    named secret (a link: with a digit), or with an identifier and a secret; a link also
    stands alone where it carries a secret itself.
    """
    parts, body = F.col("_parts"), F.col("_text")
    any_secret, endpoint = _NAMED | _PLAIN | _BARE, _HOST | _LINK

    def meets(i: Column) -> Column:
        part, stand = F.get(parts, i), F.get(F.col("_stand"), i)
        bits = F.get(F.col("_before"), i).bitwiseOR(F.get(F.col("_behind"), i))
        has = lambda mask: bits.bitwiseAND(F.lit(mask)) != 0
        whole = has(_ID) & has(any_secret)
        goes = (
            F.when(stand == _ID, has(any_secret))
            .when(stand == _NAMED, has(_ID | endpoint))
            .when(stand == _PLAIN, has(_ID | _HOST))
            .when(stand == _BARE, has(_ID))
            .when(stand == _HOST, has(_NAMED | _PLAIN) | whole)
            .when(stand == _LINK, has(_NAMED) | whole | _carries(part, body))
            .otherwise(F.lit(False))
        )
        return (part["rank"] >= len(BASE)) & goes

    return F.transform(F.filter(indexes(F.size(parts)), meets), lambda i: F.get(parts, i))


def _carries(span: Column, body: Column) -> Column:
    """Whether a link carries a secret itself."""
    return F.substring(body, span["start"] + 1, span["end"] - span["start"]).rlike(_LOADED)


def as_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", linking: Linking = ALL_ROLES
) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    A null text is empty, and has no spans.  Repeated rows are kept; no rows give none.
    """
    found = with_spans(docs.select(F.col(doc_id).alias("doc_id"), filled(text).alias("_text")), linking)
    counts = [_count(kind.name).alias(f"n_{kind.name}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(as_text("_base"), 256).alias("base_sha256"),
        as_text("_all").alias("spans"),
    )


def _count(name: str) -> Column:
    return F.size(F.filter("_base", lambda span: span["kind"] == name)).cast("bigint")


def redacted(
    docs: DataFrame, text: str = "text", size: str = "n_chars", linking: Linking = ALL_ROLES
) -> DataFrame:
    """The documents with each span replaced by ``[kind]``, columns as in ``docs``.

    Overlapping spans are replaced as one, by the first's kind.  In pairs, an endpoint
    is replaced only if it carries a secret itself or overlaps one; others stay readable.
    ``size``, where there is such a column, becomes the number of code points of a text
    that changed.  Null and empty texts stay as they are, repeated rows are treated alike,
    no rows give none.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")
    found = with_spans(docs.select(row, filled(F.col(f"`{text}`")).alias("_text")), linking)
    body = F.col("_text")
    if linking.pairs:
        ends = lambda s: s["kind"].isin("endpoint", "host") & ~_carries(s, body)
        found = found.withColumn("_all", F.filter("_all", lambda s: ~ends(s)))

    def step(done: Column, span: Column) -> Column:
        before = F.substring(body, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        mark = F.when(span["start"] < done["at"], F.lit("")).otherwise(
            F.concat(before, F.lit("["), span["kind"], F.lit("]"))
        )
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.concat(done["out"], mark).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(
        done["out"], F.substring(body, done["at"] + 1, F.char_length(body))
    )
    found = found.withColumn("_new", F.when(F.size("_all") > 0, F.aggregate("_all", start, step, rest)))
    columns = {c: F.col("_doc")[c] for c in docs.columns}
    changed = F.col("_new").isNotNull()
    columns[text] = F.coalesce("_new", columns[text])
    if size in columns:
        kind = docs.schema[size].dataType
        columns[size] = F.when(changed, F.char_length("_new").cast(kind)).otherwise(columns[size])
    return found.select(*(value.alias(c) for c, value in columns.items()))
