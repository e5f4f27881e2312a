"""Byte-level BPE encoding and decoding over a rank file, by backtracking.

Bytes are mapped to Latin-1 characters, so that one Aho-Corasick automaton finds
all tokens of a piece in one pass and with them the longest at each place. The
encoder takes the longest token that fits its left neighbour, else the next
shorter one; where none is left it gives the last token back and never returns
to that place. Two neighbouring tokens fit if no merge across their seam would
have come before the merges that made them, which is what decides whether the
exact merges leave them as they are; answers are remembered. Each place is given
up at most once, so a piece takes linear time however long it is.

Defined results: a null text is the empty text; an empty text has no token;
ties between equal merges go to the left, as in the merges themselves; texts are
taken whole and pieces never cut. Repeated rows give repeated rows, a null id is
an id like any other, the table may be empty; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import chunks, ship

NEVER = 1 << 40


def parse(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in content.splitlines() if line)}


def origin(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[int, int]:
    """The two tokens whose merge makes ``token``, by the merges before its own."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, i = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best >= rank:
            raise ValueError(f"token {rank} is not made by merges of earlier tokens")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return ranks[parts[0]], ranks[parts[1]]


class Tables:
    """What the encoder needs of a rank file, derived once and sent with the tasks."""

    def __init__(self, content: bytes):
        ranks = parse(content)
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        self.halves: list[tuple[int, int] | None] = [None] * self.size
        self.shorter = [-1] * self.size  # the longest token that the token begins with
        for token, rank in ranks.items():
            self.tokens[rank] = token
            if len(token) > 1:
                self.halves[rank] = origin(token, rank, ranks)
                self.shorter[rank] = next(ranks[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in ranks)


class Encoder:
    """Encodes pieces of text; ``remember`` bounds what is kept of earlier ones."""

    def __init__(self, tables: Tables, remember: int = 1_000_000):
        import ahocorasick

        self.size, self.halves, self.shorter = tables.size, tables.halves, tables.shorter
        self.lens = [len(t) for t in tables.tokens]
        self.ranks = {t: r for r, t in enumerate(tables.tokens) if t}
        self.merges = {h[0] * tables.size + h[1]: r for r, h in enumerate(tables.halves) if h}
        self.find = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.find.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.find.make_automaton()
        self.remember, self.fits = remember, {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side: the two
        are taken apart at their seam, latest merge first, and no merge across the
        seam may come before the merges that follow on both sides. Of equal merges
        the left one is made first."""
        left_until = right_until = NEVER
        while True:
            across = self.merges.get(left * self.size + right, NEVER)
            if across < left_until and across <= right_until:
                return False
            if self.halves[left] is None and self.halves[right] is None:
                return True
            if self.halves[right] is None or self.halves[left] is not None and left > right:
                left_until, left = left, self.halves[left][1]
            else:
                right_until, right = right, self.halves[right][0]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * (len(piece) + 1)
        for end, (back, token) in self.find.iter(piece.decode("latin-1")):
            longest[end - back] = token  # a later end is a longer token
        lens, shorter, fits, size = self.lens, self.shorter, self.fits, self.size
        if len(fits) > self.remember:
            fits.clear()
        given_up, out, at, token, last = bytearray(len(piece) + 1), [], 0, longest[0], -1
        while at < len(piece):
            while token >= 0:
                if not given_up[at + lens[token]]:
                    if last < 0:
                        break
                    pair = last * size + token
                    fit = fits.get(pair)
                    if fit is None:
                        fit = fits[pair] = self.compatible(last, token)
                    if fit:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += lens[token]
                last, token = token, longest[at]
            else:
                given_up[at] = 1
                at -= lens[last]
                out.pop()
                token = shorter[last]
                last = out[-1] if out else -1
        return out


class Known(dict):
    """Ids of pieces as little-endian bytes; short pieces are remembered."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoder.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


def encode_decode(docs: DataFrame, content: bytes, pattern: str, key: str = "doc_id", text: str = "text",
                  full: bool = False, remember: int = 500_000, slice_chars: int = 4_000_000) -> DataFrame:
    """Encode each match of ``pattern`` in every whole text by itself and decode
    the ids again.

    Returns ``key``, n_tokens, ids_sha256 (of the ids as little-endian 32-bit
    numbers) and decoded_sha256; with ``full`` also ``ids`` and ``decoded``
    (bytes). The vocabulary (1 MB) goes out with the tasks.
    """
    tables = Tables(content)
    kind = dict(docs.dtypes)[key]
    schema = f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<bigint>, decoded binary" if full else "")

    def run(batches):
        import regex

        find = regex.compile(pattern)
        known = Known(Encoder(tables, remember))
        flat = np.frombuffer(b"".join(tables.tokens), np.uint8)
        lens = np.array([len(t) for t in tables.tokens], np.int64)
        starts = np.cumsum(lens) - lens

        def ids_of(t: str) -> bytes:
            if len(t) <= slice_chars:
                return b"".join(map(known.__getitem__, find.findall(t)))
            pieces, parts = (m.group() for m in find.finditer(t)), []  # not all pieces of a very long text at once
            while some := list(islice(pieces, 100_000)):
                parts.append(b"".join(map(known.__getitem__, some)))
            return b"".join(parts)

        def bytes_of(ids: np.ndarray) -> bytes:
            n = lens[ids]
            return flat[np.arange(int(n.sum())) + np.repeat(starts[ids] - (np.cumsum(n) - n), n)].tobytes()

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at, rows in chunks(texts, 1_000_000):
                if len(known) > remember:
                    known.clear()
                coded = [ids_of(t or "") for t in texts.slice(at, rows).to_pylist()]
                ids = [np.frombuffer(x, "<u4") for x in coded]
                plain = [bytes_of(x) for x in ids]
                cols = [keys.slice(at, rows), pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in plain], pa.string())]
                if full:
                    cols += [pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())), pa.array(plain, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["k", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:len(cols)])

    return (docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, schema).withColumnRenamed("k", key))


def public_ranks(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[bytes, str]:
    """Content of a public rank file and the pattern that cuts texts into pieces."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


ship(__name__)
