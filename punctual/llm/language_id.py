"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability in a language is the sum over all its segmentations into
pieces, computed by the forward algorithm in logarithms, so it neither
vanishes for long words nor as the corpus grows; a text's is the product over
its words. The piece probabilities are fitted by expectation-maximisation
(forward-backward): one Spark aggregation counts every distinct word of the
training texts per language, each round is a pass over that table in which a
task adds up expected piece counts, and only the sums (vocabulary x languages,
a bounded table) reach the driver.

Words are the maximal runs of letters of the lower-cased text, with the
vocabulary's word mark in front, and are never cut; a character that no piece
covers counts as one unknown piece.

Defined results: a text that is null or has no letter is ``und`` with score 0;
a very long run of letters is one word (about 100 bytes of memory a letter);
without any training text all are ``und``, an empty table stays empty; ties
between languages go to the first by name; repeated rows give repeated rows and
count as often; other columns are not read, whatever their names. The number of
languages is a parameter: ``train`` raises a ValueError over ``most_languages``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import chunks, materialize, mix, ship

MARK = "▁"
REMEMBER = 200_000     # words that a task keeps in memory
LETTERS = 50_000       # letters of the words that are scored together
CELLS = 4_000_000      # log-probabilities held at a time


def public_pieces(name: str = "piece_bpe_32k.model") -> list[str]:
    """The distinct lower-case pieces of a public vocabulary, without control
    and byte pieces."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    usual = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return sorted({sp.id_to_piece(i).lower() for i in usual})


def codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def hash_step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of a string with one more character at its end."""
    return mix(h * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(1))


class Pieces:
    """Finds the pieces that begin at each place of a word: a table of all
    beginnings of pieces tells when no longer piece can follow."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)  # the id of the unknown piece
        ids = {p: i for i, p in enumerate(pieces)}
        parts = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)}, key=len)
        value = np.array([ids.get(p, -1) for p in parts], np.int32)
        lens = np.array([len(p) for p in parts], np.int64)
        h, flat, start = np.zeros(len(parts), np.uint64), codes(parts), np.cumsum(lens) - lens
        for k in range(int(lens.max()) if len(parts) else 0):
            some = np.flatnonzero(lens > k)
            h[some] = hash_step(h[some], flat[start[some] + k])
        # slots by the hash's first bits; those that share a slot go to the next table
        bits = max(10, int(len(parts)).bit_length() + 4)
        self.shift, self.hashes, self.value = np.uint64(64 - bits), np.append(h, np.uint64(0)), np.append(value, np.int32(-2))
        self.tables, left = [], np.arange(len(parts))
        while len(left):
            slot = h[left] >> self.shift
            _, first = np.unique(slot, return_index=True)
            table = np.full(1 << bits, len(parts), np.int32)
            table[slot[first]] = left[first]
            self.tables.append(table)
            left = np.delete(left, first)

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Piece id; -1 for the beginning of a piece only; -2 for neither."""
        out = np.full(len(h), -2, np.int32)
        slot = h >> self.shift
        for table in self.tables:
            at = table[slot]
            hit = self.hashes[at] == h
            out[hit] = self.value[at[hit]]
        return out

    def lattice(self, words: list[str]):
        """(words, length, place, size, piece) for words of one length: every
        piece that lies in a word, ``place`` counting through all words. A
        character that is no piece is the unknown piece."""
        n, m = len(words), len(words[0])
        c = codes(words)
        at, h, found = np.arange(n * m), np.zeros(n * m, np.uint64), []
        for k in range(1, m + 1):
            room = at % m + k <= m
            at, h = at[room], h[room]
            h = hash_step(h, c[at + k - 1])
            piece = self.look_up(h)
            if k == 1:
                found.append((at, np.where(piece >= 0, piece, self.size)))
            else:
                found.append((at[piece >= 0], piece[piece >= 0]))
            longer = piece > -2
            at, h = at[longer], h[longer]
            if not len(at):
                break
        size = np.repeat(np.arange(1, len(found) + 1), [len(a) for a, _ in found])
        return n, m, np.concatenate([a for a, _ in found]), size, np.concatenate([p for _, p in found])


def sum_paths(n: int, m: int, here: np.ndarray, there: np.ndarray, row: np.ndarray, log_p: np.ndarray, order: range) -> np.ndarray:
    """[place, word, language]: log-probability of all paths to each place, in
    ``order`` of the places from the known first one. Step i leads word row[i]
    from place there[i] to here[i] with log-probabilities log_p[i]; every place
    of every word but the first has a step."""
    out = np.zeros((m + 1, n, log_p.shape[1]))
    flat, at = out.reshape(-1, log_p.shape[1]), here * n + row
    by = np.argsort(at, kind="stable")
    at, source, log_p = at[by], (there * n + row)[by], log_p[by]
    first = np.flatnonzero(np.diff(at, prepend=-1))  # of the steps to one place of one word
    many = np.diff(first, append=len(at))
    ends = np.searchsorted(at, np.arange(m + 2) * n)
    groups = np.searchsorted(first, ends)
    for place in order:
        a, b, some = ends[place], ends[place + 1], slice(groups[place], groups[place + 1])
        x = flat[source[a:b]]
        x += log_p[a:b]
        most = np.maximum.reduceat(x, first[some] - a)
        x -= np.repeat(most, many[some], axis=0)
        out[place] = most + np.log(np.add.reduceat(np.exp(x, out=x), first[some] - a))
    return out


def log_forward(lattice, log_prob: np.ndarray) -> np.ndarray:
    """[place, word, language]: log-probability of all segmentations up to a
    place. ``log_prob`` is [piece, language], the unknown piece in its last row."""
    n, m, at, size, piece = lattice
    start = at % m
    return sum_paths(n, m, start + size, start, at // m, log_prob[piece], range(1, m + 1))


def forward(lattice, prob: np.ndarray) -> np.ndarray:
    """The same as probabilities, [word, place, language]."""
    return np.exp(log_forward(lattice, np.log(prob))).transpose(1, 0, 2)


def slices(lattice, languages: int):
    """Ranges of languages whose tables fit in CELLS numbers."""
    step = max(1, CELLS // len(lattice[2]))
    return [slice(i, i + step) for i in range(0, languages, step)]


def word_logs(lattice, log_prob: np.ndarray) -> np.ndarray:
    """[word, language]: log-probability of whole words."""
    parts = [log_forward(lattice, log_prob[:, some])[-1] for some in slices(lattice, log_prob.shape[1])]
    return np.concatenate(parts, axis=1) if parts else np.zeros((lattice[0], 0))


def expected(lattice, prob: np.ndarray, weight: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out`` [piece, language] the expected piece counts of words that
    occur ``weight`` [word, language] times."""
    n, m, at, size, piece = lattice
    row, start = at // m, at % m
    if prob.shape[1] > 1 and (prob == prob[:, :1]).all():  # before the first round: one table does for all languages
        log_p = np.log(prob[:, :1])[piece]
        before = sum_paths(n, m, start + size, start, row, log_p, range(1, m + 1))
        after = sum_paths(n, m, start, start + size, row, log_p, range(m - 1, -1, -1))
        share = np.exp(before[start, row] + log_p + after[start + size, row] - before[m][row])[:, 0]
        for k in np.flatnonzero(weight.any(axis=0)):
            out[:, k] += np.bincount(piece, share * weight[row, k], len(out))
        return
    for some in slices(lattice, prob.shape[1]):
        if not weight[:, some].any():
            continue
        log_p = np.log(prob[:, some])[piece]
        before = sum_paths(n, m, start + size, start, row, log_p, range(1, m + 1))
        after = sum_paths(n, m, start, start + size, row, log_p, range(m - 1, -1, -1))
        share = np.exp(before[start, row] + log_p + after[start + size, row] - before[m][row]) * weight[:, some][row]
        for k in range(share.shape[1]):
            out[:, some.start + k] += np.bincount(piece, share[:, k], len(out))


def by_length(words: list[str]):
    """(positions, words) of words of one length, about LETTERS letters at a time."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        end, size = at, len(words[order[at]])
        while end < len(order) and len(words[order[end]]) == size and (end == at or (end - at + 1) * size <= LETTERS):
            end += 1
        yield order[at:end], [words[i] for i in order[at:end]]
        at = end


def count_words(docs: DataFrame) -> DataFrame:
    """word (with its mark), k, n: how often each word occurs in rows (text, k)."""

    def run(batches):
        import regex
        from collections import Counter

        find = regex.compile(r"\p{L}+").findall
        seen: dict[int, Counter] = {}

        def rows():
            for k, tokens in seen.items():
                words = Counter()
                for token, n in tokens.items():
                    for w in find(token):
                        words[w] += n
                yield pa.RecordBatch.from_arrays([pa.array([MARK + w for w in words], pa.string()), pa.array([k] * len(words), pa.int32()),
                                                  pa.array(list(words.values()), pa.int64())], ["word", "k", "n"])
            seen.clear()

        for batch in batches:
            for at, size in chunks(batch.column(0)):
                for text, k in zip(batch.column(0).slice(at, size).to_pylist(), batch.column(1).slice(at, size).to_pylist()):
                    seen.setdefault(k, Counter()).update((text or "").lower().split())
                if sum(map(len, seen.values())) > REMEMBER:
                    yield from rows()
        yield from rows()

    return docs.mapInArrow(run, "word string, k int, n long").groupBy("word", "k").agg(F.sum("n").alias("n"))


def count_pieces(words: DataFrame, pieces: list[str], prob: np.ndarray) -> np.ndarray:
    """Expected piece counts [piece, language] over a table of (word, uses), uses
    being (k, n) of the languages that have the word."""

    def run(batches):
        table, total = Pieces(pieces), np.zeros_like(prob)
        for batch in batches:
            words, uses = batch.column(0).to_pylist(), batch.column(1)
            flat = uses.flatten()
            row = np.repeat(np.arange(len(words)), np.diff(uses.offsets.to_numpy()))
            k, n = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            edge = np.searchsorted(row, np.arange(len(words) + 1))
            for at, part in by_length(words):
                weight = np.zeros((len(part), prob.shape[1]))
                for i, j in enumerate(at):
                    weight[i, k[edge[j]:edge[j + 1]]] = n[edge[j]:edge[j + 1]]
                expected(table.lattice(part), prob, weight, total)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], ["piece", "lang", "n"])

    sums = words.mapInArrow(run, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
    out = np.zeros((len(pieces) + 1, prob.shape[1]))
    for piece, lang, n in sums.collect():  # at most vocabulary x languages rows
        out[piece, lang] = n
    return out


def train(spark: SparkSession, docs: DataFrame, pieces: list[str], text: str = "text", lang: str = "lang",
          rounds: int = 2, smooth: float = 0.1, most_languages: int = 500) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log prior, P(piece) [piece, language]) from all rows of
    ``docs`` whose language is given; a ValueError over ``most_languages``."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL")
    shares = sorted(tuple(r) for r in rows.groupBy("lang").count().limit(most_languages + 1).collect())
    if len(shares) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = [x for x, _ in shares]
    prior = np.log(np.array([n for _, n in shares], float) / max(1, sum(n for _, n in shares)))
    prob = np.full((len(pieces) + 1, len(languages)), 1 / (len(pieces) + 1))
    if not languages:
        return languages, prior, prob
    index = F.create_map(*[F.lit(x) for pair in zip(languages, range(len(languages))) for x in pair])
    rows = rows.select("text", index[F.col("lang")].cast("int").alias("k"))
    uses = count_words(rows).groupBy("word").agg(F.collect_list(F.struct("k", "n")).alias("uses"))  # a language each at most
    words = materialize(spark, uses, "words")
    for _ in range(rounds):
        counts = count_pieces(words, pieces, prob) + smooth
        prob = counts / counts.sum(axis=0)
    return languages, prior, prob


class Scorer:
    """Log-probabilities of tokens in every language; remembers some of them."""

    def __init__(self, pieces: list[str], prob: np.ndarray):
        import regex

        self.find, self.table = regex.compile(r"\p{L}+").findall, Pieces(pieces)
        self.log_prob = np.log(prob)
        self.most = max(1000, 10 * CELLS // (prob.shape[1] + 1))  # tokens to remember
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, self.log_prob.shape[1] + 1))
        self.chars = 0

    def learn(self, tokens: set[str]) -> None:
        if len(self.place) + len(tokens) > min(self.most, 2 * REMEMBER) or self.chars > 50 * REMEMBER:
            self.forget()
        new = [t for t in tokens if t not in self.place]
        split = [[MARK + w for w in self.find(t)] for t in new]
        words = list({w for ws in split for w in ws})
        value = np.zeros((len(words), self.log_prob.shape[1] + 1))
        for at, part in by_length(words):
            value[at, :-1] = word_logs(self.table.lattice(part), self.log_prob)
        value[:, -1] = 1  # counts the words
        of = {w: i for i, w in enumerate(words)}
        add = np.zeros((len(new), value.shape[1]))
        size = np.array([len(ws) for ws in split], np.int64)
        which, place = np.repeat(np.arange(len(new)), size), np.array([of[w] for ws in split for w in ws], np.int64)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        add[which[nth == 0]] = value[place[nth == 0]]  # most tokens have one word
        np.add.at(add, which[nth > 0], value[place[nth > 0]])
        self.place.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.chars += sum(map(len, new))
        self.rows = np.concatenate((self.rows, add))

    def totals(self, texts: list[str]) -> np.ndarray:
        """[text, language + 1]: log-probability of the words, and their number."""
        split = [t.lower().split() for t in texts]
        self.learn(set().union(*split))
        out = np.zeros((len(texts), self.rows.shape[1]))
        step = max(1, CELLS // self.rows.shape[1])
        for i, tokens in enumerate(split):
            places = np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens))
            for at in range(0, len(places), step):
                out[i] += self.rows[places[at:at + step]].sum(axis=0)
        return out


def predict(docs: DataFrame, model, pieces: list[str], keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, lang_pred, score (posterior of that language) of every row."""
    languages, prior, prob = model
    types = dict(docs.dtypes)

    def run(batches):
        scorer = Scorer(pieces, prob)
        for batch in batches:
            column = batch.column(len(keys))
            for at, size in chunks(column, 1_000_000):
                totals = scorer.totals([t or "" for t in column.slice(at, size).to_pylist()])
                names, scores = [], []
                for row in totals:
                    if row[-1] and languages:
                        w = np.exp(row[:-1] + prior - (row[:-1] + prior).max())
                        names.append(languages[int(w.argmax())])
                        scores.append(float(w.max() / w.sum()))
                    else:
                        names.append("und")
                        scores.append(0.0)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, size) for i in range(len(keys))), pa.array(names, pa.string()),
                                                  pa.array(scores, pa.float64())], [*keys, "lang_pred", "score"])

    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", lang_pred string, score double"
    return docs.select(*keys, text).mapInArrow(run, schema)


def identify(spark: SparkSession, docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from the rows that aren't held out, predict all."""
    docs = docs.select("doc_id", held_out.alias("held_out"), "text", "lang")
    pieces = public_pieces()
    model = train(spark, docs.where("NOT held_out"), pieces)
    return predict(docs, model, pieces, ["doc_id", "held_out"])


ship(__name__)
