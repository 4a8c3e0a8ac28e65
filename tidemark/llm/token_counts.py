"""Exact token counts at every prefix by dynamic programming, for counts, budgets and truncation."""

import functools
import json
import re

import pyarrow as pa
import regex
from tokenizers import Tokenizer

from . import bpe
from .common import bare, flushed, rows_of

#: Totals of chunks and states of prefixes that a worker keeps; a generation is dropped when full.
CACHE_ENTRIES = 150_000
STATE_ENTRIES = 500_000

#: Characters whose classes are the same in every Unicode version the libraries carry.
_SETTLED = re.compile("[^\x00-՗]")
#: Fixed value: the contractions of the pre-tokenizer pattern.
_CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}


class PrefixTable:
    """Token counts of one vocabulary file; the table of a piece holds the count at each of its byte prefixes."""

    def __init__(self, path):
        self.vocabulary = bpe.load(path)
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.special_in = lambda text: any(t in text for t in self.special)
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pattern = regex.compile(bpe.PATTERN)
        self.totals, self.states = _Totals(self), {}

    def state(self, data):
        """Last token and count of one prefix of a piece, as ``token << 24 | count``.

        The encoding of a prefix is the encoding of a shorter prefix followed by one last token, namely the only
        token that ends there and stands stably beside the shorter prefix's last token. Only the shorter prefixes
        that a total leans on are solved; states are kept, so pieces that begin alike share them.
        """
        known = self.states.get(data)
        if known is not None:
            return known
        states, v = self.states, self.vocabulary
        ranks, pairs = v.ranks, v.pairs
        token = ranks.get(data)
        if token is not None and v.own(token):
            found = token << 24 | 1
        else:
            for start in range(max(1, len(data) - v.longest), len(data)):
                token = ranks.get(data[start:])
                if token is not None:
                    before = states.get(data[:start])
                    if before is None:
                        before = self.state(data[:start])
                    key = before >> 24 << 20 | token
                    fits = pairs.get(key)
                    if fits or fits is None and v.stable(before >> 24, token):
                        found = token << 24 | (before & 0xFFFFFF) + 1
                        break
        states[data] = found
        return found

    def total(self, data):
        """Count of a whole piece."""
        if len(data) > 64:
            return self.piece(data)[-1]
        if len(self.states) >= STATE_ENTRIES:
            self.states.clear()
        return self.state(data) & 0xFFFFFF

    def piece(self, data):
        """Counts at byte prefixes 0 to len(data) of one piece, by the same rule, shorter prefixes first."""
        v, last, counts = self.vocabulary, [None], [0]
        for end in range(1, len(data) + 1):
            for start in range(max(0, end - v.longest), end):
                token = v.ranks.get(data[start:end])
                if token is not None and (v.stable(last[start], token) if start else v.own(token)):
                    break
            last.append(token)
            counts.append(counts[start] + 1)
        return counts

    def spans(self, text):
        """(start, end, special) of the pieces in order, in characters."""
        at = 0
        for k, part in enumerate(self.split_special.split(text) if self.split_special else [text]):
            if k % 2:
                yield at, at + len(part), True
            elif part:
                if _SETTLED.search(part):
                    for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(part):
                        yield at + a, at + b, False
                else:
                    for m in self.pattern.finditer(part):
                        yield at + m.start(), at + m.end(), False
            at += len(part)

    def count(self, text):
        """Tokens of a stretch that starts and ends at piece borders."""
        if not self.special_in(text) and not _SETTLED.search(text):
            total, known = 0, self.states.get
            for data in map(str.encode, self.pattern.findall(text)):
                state = known(data)
                total += self.total(data) if state is None else state & 0xFFFFFF
            return total
        return sum(1 if special else self.total(text[a:b].encode()) for a, b, special in self.spans(text))

    def prefixes(self, text):
        """Exact token counts of text[:0], text[:1], ... text[:len(text)], each as if that prefix stood alone."""
        out, before, run_start, run_before, prior = [0], 0, None, 0, (0, 0)
        for a, b, special in self.spans(text):
            piece = text[a:b]
            if special or piece in _CONTRACTIONS:
                # cut short, these join what stands before them, so the piece before is split again too
                back, at_back = prior if run_start is None else (run_start, run_before)
                out += [at_back + self.count(text[back:a + i]) for i in range(1, b - a)]
                prior = (b, before + 1) if special else (a, before)
                before += 1 if special else self.piece(piece.encode())[-1]
                out.append(before)
                run_start = None
                continue
            table = self.piece(piece.encode())
            spaces = len(piece) - len(piece.lstrip())
            if spaces and run_start is None:
                run_start, run_before = a, before
            at = 0
            for i, c in enumerate(piece):
                at += len(c.encode())
                if i < spaces:  # a prefix that ends in white space ends in one piece of all that white space
                    out.append(run_before + self.piece(text[run_start:a + i + 1].encode())[-1])
                else:
                    out.append(before + table[at])
            prior = (a, before)
            before += table[-1]
            if spaces < len(piece):
                run_start = None
        return out


class _Totals(dict):
    """Totals of recent chunks in two generations: the older one goes when the younger is full."""

    def __init__(self, table):
        self.table, self.older = table, {}

    def __missing__(self, chunk):
        total = self.older.get(chunk)
        if total is None:
            total = self.table.count(chunk)
        if len(chunk) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[chunk] = total
        return total


@functools.lru_cache(maxsize=4)
def load(path):
    return PrefixTable(path)


def count_text(text, path):
    return sum(map(load(path).totals.__getitem__, bpe.cuts(text))) if text else 0


def count_tokens(docs, path, limit=512, id_col="doc_id", text_col="text"):
    """Counts of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``.

    The total is the last entry of the prefix table, summed over stretches between cuts that no token crosses.
    NULL and empty texts count 0. Repeated rows and NULL ids stay; extra columns are left out; an empty table
    gives an empty table.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches):
        def row(doc_id, text):
            n = count_text(text, path)
            return doc_id, len((text or "").encode()), n, n > limit

        for batch in batches:
            yield from flushed((row(i, t) for i, t in rows_of(batch, "doc_id", "text")), schema)

    return bare(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")


def prefix_counts(docs, path, id_col="doc_id", text_col="text"):
    """``doc_id, prefix_tokens``: entry p is the exact count of the text's first p characters (0 to its length)."""
    schema = pa.schema([("doc_id", pa.int64()), ("prefix_tokens", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            yield from flushed(((i, load(path).prefixes(t or "")) for i, t in rows_of(batch, "doc_id", "text")), schema, 16)

    return bare(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, prefix_tokens array<int>")


def truncate(docs, path, budget, id_col="doc_id", text_col="text"):
    """``doc_id, text, n_tokens``: the longest prefix of at most ``budget`` tokens, read off the prefix table."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64())])

    def run(batches):
        def row(doc_id, text):
            counts = load(path).prefixes(text or "")
            end = max(p for p, n in enumerate(counts) if n <= budget)
            return doc_id, (text or "")[:end], counts[end]

        for batch in batches:
            yield from flushed((row(i, t) for i, t in rows_of(batch, "doc_id", "text")), schema, 64)

    return bare(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, text string, n_tokens bigint")
