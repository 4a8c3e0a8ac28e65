"""Secret scans: base patterns, and weaker parts that are reported only where complementary parts stand together."""

import bisect
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import functions as F

from .common import bare, flushed, rows_of

#: Widest gap, in characters between one part's end and the next one's start, at which two parts belong to one credential.
SCOPE = 256

#: The base kinds. Letters match in either case only among ASCII letters.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Weaker parts. They count as evidence for each other but are no finding alone.
LOGIN = re.compile(r"""(?:user(?:name)?|login|account|client_id|access_key_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.+-]{3,}""", re.I | re.A)
LOGIN_WORDS = ("user", "login", "account", "client_id", "access_key_id")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{32,}={0,2}")
ENDPOINT = re.compile(r"""(?:https?|jdbc:[a-z]+|s3|ftp)://[^\s"'<>]+""")

#: Kinds in listed order; the part of a credential each can be, and whether it stands alone.
KINDS = ["assign", "access", "hex", "weak_assign", "weak_access", "login", "random", "endpoint"]
PART = {"assign": "secret", "access": "identifier", "hex": "secret", "weak_assign": "secret", "weak_access": "identifier",
        "login": "identifier", "random": "secret", "endpoint": "endpoint"}
STRONG = {"assign", "access", "hex"}


def find_parts(text):
    """All (kind, start, end) of a text, strong and weak, in characters."""
    lowered, out = text.lower(), []
    if any(w in lowered for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            out.append(("assign" if m.end(2) - m.start(2) >= 6 else "weak_assign", m.start(), m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            out.append(("access" if m.end() - m.start() >= 20 else "weak_access", m.start(), m.end()))
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    if any(w in lowered for w in LOGIN_WORDS):
        out += [("login", *m.span()) for m in LOGIN.finditer(text)]
    out += [("random", *m.span()) for m in RANDOM.finditer(text)]
    if "://" in text:
        out += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    return out


def link(parts, scope=SCOPE):
    """Strong parts, and weak ones with a complementary part at a gap of at most ``scope``; parts that overlap have none.

    An interval join: for each kind of part the starts in order, and the greatest end up to each of them. A part has a partner if, among those that start
    at most ``scope`` behind its end, one ends at most ``scope`` before its start. A secret needs an identifier or an
    endpoint, an identifier or endpoint needs a secret. Each part costs one search, whatever the text holds.
    """
    starts, ends = {}, {}
    for p in ("secret", "identifier", "endpoint"):
        spans = sorted((s, e) for k, s, e in parts if PART[k] == p)
        starts[p], ends[p] = [s for s, _ in spans], list(accumulate((e for _, e in spans), max))

    def near(part, start, end):
        n = bisect.bisect_right(starts[part], end + scope)
        return n > 0 and ends[part][n - 1] >= start - scope

    def kept(kind, start, end):
        if kind in STRONG:
            return True
        return near("identifier", start, end) or near("endpoint", start, end) if PART[kind] == "secret" else near("secret", start, end)

    return sorted((x for x in parts if kept(*x)), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(docs, scope=SCOPE, id_col="doc_id", text_col="text"):
    """Findings of every whole text: ``doc_id, spans`` as an array of (kind, start, end_at), in text order.

    Row by row, so no text is shuffled and a hot source or a very long text costs only its own length.
    NULL and empty texts give an empty array; NULL ids and repeated rows stay; extra columns are left out; an empty
    table gives an empty table. Parts that start together are listed by kind.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end_at", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def run(batches):
        for batch in batches:
            yield from flushed(((i, [dict(kind=k, start=a, end_at=b) for k, a, b in link(find_parts(t or ""), scope)])
                                for i, t in rows_of(batch, "doc_id", "text")), schema)

    return bare(docs, doc_id=id_col, text=text_col).mapInArrow(
        run, "doc_id bigint, spans array<struct<kind: string, start: int, end_at: int>>")


def digest(docs, scope=SCOPE, id_col="doc_id", text_col="text"):
    """Counts and digests of ``scan``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    found = scan(docs, scope, id_col, text_col)

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end_at"].cast("string"))), ",")

    def only(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = only(*KINDS[:3])
    counts = [F.size(only(k)).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
