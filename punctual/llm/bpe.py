"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The vocabulary is a public tokenizer file whose path is a parameter. A text is
split at the file's added tokens, then by the public byte-level pattern; each
distinct piece of a batch is encoded once. All those pieces lie in one flat
array of symbols: a round looks up every neighbouring pair by binary search
over the sorted pair keys, takes the lowest rank of each piece, merges all its
places (from the left where they overlap) and drops the pieces that have no
pair left.

Defined results: a null text is the empty text; an empty text has no token.
Texts are never cut; a very long piece only takes more rounds. Repeated rows
give repeated rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from punctual.llm.common import chunks, ship

NO_RANK = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in such vocabularies:
    visible Latin-1 characters stand for themselves, the others follow at 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in visible:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class Merges:
    """Vocabulary and merge table of a byte-level BPE file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        vocab: dict[str, int] = spec["model"]["vocab"]
        symbols = byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        self.byte_ids = np.array([vocab[c] for c in symbols], np.int64)
        self.size = max(*vocab.values(), *(t["id"] for t in spec.get("added_tokens", [{"id": 0}]))) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        of = {i: bytes(back[c] for c in t) for t, i in vocab.items() if t not in self.added}
        of |= {i: t.encode() for t, i in self.added.items()}
        table = [of.get(i, b"") for i in range(self.size)]
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.lens = np.array([len(t) for t in table], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens

    def look_up(self, sym, word, at) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of the pairs that begin at ``at``: binary
        search over the sorted pair keys; NO_RANK where a pair has no merge."""
        after = np.minimum(at + 1, len(sym) - 1)
        key = sym[at] * self.size + sym[after]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        good = (self.keys[found] == key) & (word[at] == word[after]) & (after > at)
        return np.where(good, self.ranks[found], NO_RANK), self.made[found]

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word (all in one flat array)."""
        lens = np.array([len(w) for w in words], np.int64)
        sym = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        out_sym, out_word = [], []
        rank, made = self.look_up(sym, word, np.arange(len(sym)))
        while len(sym):
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.minimum.reduceat(rank, start)
            lowest = np.repeat(lowest, np.diff(np.append(start, len(sym))))
            keep = lowest < NO_RANK
            out_sym.append(sym[~keep])
            out_word.append(word[~keep])
            hit = np.flatnonzero(keep & (rank == lowest))
            if len(hit):
                # in a run of overlapping places every second one, from the left
                first = np.flatnonzero(np.concatenate(([True], np.diff(hit) > 1)))
                depth = np.arange(len(hit)) - np.repeat(first, np.diff(np.append(first, len(hit))))
                hit = hit[depth % 2 == 0]
                sym[hit] = made[hit]
                keep[hit + 1] = False
            # only pairs that touch a merged symbol are looked up again
            place = np.cumsum(keep) - 1
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            now = place[hit]
            touched = np.zeros(len(sym), bool)
            touched[now] = touched[np.maximum(now - 1, 0)] = True
            new = np.flatnonzero(touched)
            rank[new], made[new] = self.look_up(sym, word, new)
        if not out_sym:
            return [np.zeros(0, np.int64) for _ in words]
        sym, word = np.concatenate(out_sym), np.concatenate(out_word)
        order = np.argsort(word, kind="stable")
        bounds = np.searchsorted(word[order], np.arange(len(words) + 1))
        sym = sym[order]
        return [sym[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids, gathered from one flat table."""
        lens = self.lens[ids]
        place = np.arange(int(lens.sum())) + np.repeat(self.starts[ids] - (np.cumsum(lens) - lens), lens)
        return self.flat[place].tobytes()


class Codec:
    """Encodes and decodes texts; remembers a bounded number of text parts.

    A single space between two other characters always begins a new piece and
    a single newline between two others is a piece of its own, so a text may
    be cut there and each word be looked up whole: in ``known[0]`` at the start
    of a line, in ``known[1]`` after a space. A text with other white space is
    matched with the pattern as a whole.
    """

    def __init__(self, content: str, pattern: str, remember: int = 500_000, flat: int = 4_000_000):
        import regex

        self.merges = Merges(content)
        self.find = regex.compile(pattern).findall
        self.added = regex.compile("|".join(map(regex.escape, sorted(self.merges.added, key=len, reverse=True))) or r"(?!)")
        self.plain = lambda t, odd=regex.compile(r"[^\S\n ]").search: not (
            t[:1].isspace() or t[-1:].isspace() or "  " in t or "\n\n" in t or " \n" in t or "\n " in t or odd(t))
        self.remember, self.room = remember, flat
        self.names = [str(i) for i in range(self.merges.size)]
        self.pieces: dict[str, str] = {}
        self.known: tuple[dict[str, str], dict[str, str]] = ({}, {})

    def learn(self, wanted: set[str], kind: int) -> None:
        """Add words to ``known[kind]``, new pieces in flat arrays of bounded size."""
        wanted = [w for w in wanted if w not in self.known[kind]]
        if not wanted:
            return
        parts = [" " * kind + w for w in wanted]
        split = list(map(self.find, parts))
        pieces, size = [], 0
        for p in set().union(*split):
            if p in self.pieces:
                continue
            pieces.append(p)
            size += len(p)
            if size >= self.room:
                self._encode(pieces)
                pieces, size = [], 0
        if pieces:
            self._encode(pieces)
        of, known = self.pieces, self.known[kind]
        for w, ps in zip(wanted, split):
            known[w] = of[ps[0]] if len(ps) == 1 else ",".join([of[p] for p in ps])

    def _encode(self, pieces: list[str]) -> None:
        for p, ids in zip(pieces, self.merges.encode([p.encode() for p in pieces])):
            self.pieces[p] = ",".join([self.names[i] for i in ids])

    def encode(self, texts: list[str]):
        """The ids of each text, joined by commas."""
        if len(self.pieces) + sum(map(len, self.known)) > 2 * self.remember:
            self.pieces.clear()
            self.known[0].clear()
            self.known[1].clear()
        plan, first, rest, whole = [], set(), set(), set()
        for t in texts:
            row, at = [], 0
            for m in [*self.added.finditer(t), None] if any(x in t for x in self.merges.added) else [None]:
                part = t[at:m.start()] if m else t[at:] if at else t
                if part and self.plain(part):
                    lines = [line.split(" ") for line in part.split("\n")]
                    row.append(lines)
                    for line in lines:
                        first.add(line[0])
                        rest.update(line[1:])
                elif part:
                    row.append(ps := self.find(part))
                    whole.update(ps)
                if m:
                    row.append(self.merges.added[m.group()])
                    at = m.end()
            plan.append(row)
        self.learn(first, 0)
        self.learn(rest, 1)
        whole.add("\n")
        if new := [p for p in whole if p not in self.pieces]:
            self._encode(new)
        head, tail, of = self.known[0], self.known[1].__getitem__, self.pieces.__getitem__
        newline = f",{of('\n')},"
        for row in plan:
            yield ",".join([
                str(x) if isinstance(x, int) else ",".join(map(of, x)) if isinstance(x[0], str)
                else newline.join([",".join([head[line[0]], *map(tail, line[1:])]) for line in x]) for x in row])

    def decode(self, ids: str) -> str:
        """The text of ids joined by commas."""
        return self.merges.decode(np.fromstring(ids, np.int64, sep=",")).decode("utf-8", "replace") if ids else ""


def encode_decode(docs: DataFrame, content: str, pattern: str, text: str = "text",
                  key: str = "doc_id", full: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns ``key``, n_tokens, ids_sha256, decoded_sha256; with ``full`` also
    ``ids`` and ``decoded``.
    """
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if full else "")

    def run(batches):
        codec = Codec(content, pattern)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at, size in chunks(texts):
                ids = list(codec.encode([t or "" for t in texts.slice(at, size).to_pylist()]))
                plain = [codec.decode(x) for x in ids]
                n = [x.count(",") + 1 if x else 0 for x in ids]
                cols = [keys.slice(at, size), pa.array(n, pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in plain])]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                if full:
                    lists = [np.fromstring(x, np.int32, sep=",") if x else np.zeros(0, np.int32) for x in ids]
                    cols += [pa.array(lists, pa.list_(pa.int32())), pa.array(plain)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(key, text).mapInArrow(run, schema)


def public_vocabulary(name: str = "byte_bpe_50k.json") -> tuple[str, str]:
    """Content of a public tokenizer file (1.5 MB, sent with the tasks) and the
    pattern that cuts texts into pieces."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read(), public_tokenizers.PATTERN


ship(__name__)
