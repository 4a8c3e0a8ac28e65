"""Byte-level BPE: vocabulary ranks, provably stable token borders, cuts that no token can cross."""

import base64
import functools
import json
import re

import tiktoken

#: Fixed value: the pre-tokenizer pattern of the published byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Answers kept about pairs of tokens; emptied when full, so a worker's memory is bounded.
PAIR_ENTRIES = 400_000

_SPACES = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def _byte_of():
    """Character to byte in JSON vocabularies: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def read_ranks(path):
    """Token bytes to rank, from a ``.tiktoken`` or ``.json`` file; added tokens of a JSON file are left out."""
    with open(path, "rb") as f:
        if not path.endswith(".json"):
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        of, loaded = _byte_of(), json.load(f)
    added = {t["content"] for t in loaded.get("added_tokens", [])}
    return {bytes(of[c] for c in t): i for t, i in loaded["model"]["vocab"].items() if t not in added}


def cuts(text):
    """``text`` in chunks that start at a space after a visible character.

    In every pattern of this family a space stands only at a token's start or inside white space, and no
    token looks back, so no token crosses such a border and each chunk encodes by itself.
    """
    if _SPACES.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]


class Bpe:
    """Merges by rank, the question whether a border between two tokens is stable, and the join of encodings."""

    def __init__(self, ranks, pattern=PATTERN):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.longest = max(map(len, ranks))
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pairs, self._own = {}, {}

    def merged(self, data):
        """The merges' own result for ``data`` as one piece, also where ``data`` is itself a vocabulary entry."""
        if data not in self.ranks:
            return self.library._core_bpe.encode_single_piece(data)
        parts = [bytes([b]) for b in data]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], 1 << 40), i))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def own(self, token):
        """True if the merges reach the token from its own bytes."""
        known = self._own.get(token)
        if known is None:
            known = self._own[token] = self.merged(self.bytes_of[token]) == [token]
        return known

    def stable(self, left, right):
        """True if the two tokens beside each other encode to themselves.

        A token sequence is the encoding of its bytes exactly if all neighbours are stable: a merge across a
        border would need a pair of neighbours that merges.
        """
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            data = self.bytes_of[left] + self.bytes_of[right]
            whole = self.ranks.get(data)
            if whole is None:
                known = self.library._core_bpe.encode_single_piece(data) == [left, right]
            else:
                known = not self.own(whole) and self.merged(data) == [left, right]
            self.pairs[key] = known
        return known

    def join(self, left, right):
        """The encoding of two neighbouring stretches, from their own encodings.

        Tokens around the border are encoded again, in a window that doubles until both its borders are stable;
        tokens outside it then cannot change.
        """
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        size = 2
        while True:
            head, tail = left[:-size], right[size:]
            window = self.merged(b"".join(self.bytes_of[t] for t in left[-size:] + right[:size]))
            if (not head or self.stable(head[-1], window[0])) and (not tail or self.stable(window[-1], tail[0])):
                return head + window + tail
            size *= 2

    def tree(self, data, leaf=1024):
        """Encoding of one piece by halves: leaves by the merges, then neighbours joined upwards."""
        if len(data) <= leaf:
            return self.merged(data)
        middle = len(data) // 2
        return self.join(self.tree(data[:middle], leaf), self.tree(data[middle:], leaf))

    def piece(self, data, leaf=1024):
        """Encoding of one match of the pattern; a match that is an entry takes its id, as the library does."""
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.tree(data, leaf)

    def decode(self, ids, leaf=4096):
        """Bytes of ``ids``, joined up a tree of halves."""
        if len(ids) <= leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf) + self.decode(ids[middle:], leaf)


@functools.lru_cache(maxsize=4)
def load(path, pattern=PATTERN):
    """One vocabulary per worker process."""
    return Bpe(read_ranks(path), pattern)
