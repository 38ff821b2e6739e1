"""Exact token counts of every prefix by dynamic programming over a byte-level BPE vocabulary.

A token sequence is what the merge rules make of its bytes exactly if every two neighbours are what the rules make of their
joined bytes. So the last token of each prefix is the one token that ends there and is compatible with the last token of what it leaves
(van Antwerpen and Neubeck 2024). Going through a word byte by byte, the count of a prefix is one more than the count of what its
last token leaves: a table of last tokens and counts, filled once, that answers truncation and budget questions without encoding again.

Words are those of the vocabulary's split pattern. A prefix may end inside a word or a run of white space; the counts are those of the
prefix as a text of its own, for every code point.

Defined results: a NULL text is empty and has no tokens; rows with equal ids are counted one by one; an empty table gives an empty
table; other columns are ignored. Special tokens inside a text count as one token, as the library does by default; a prefix that
ends inside one counts as plain text.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from confluo.llm.bpe import PieceEncoder, Vocabulary, settled, words
from confluo.llm.common import Batches, pick, small_batches, str_texts

LIMIT = 1024


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


class PrefixCounter:
    """Token counts of prefixes under one vocabulary."""

    def __init__(self, path: str, room: int = 250_000):
        self.vocabulary = Vocabulary(path)
        self.room = room
        self.library = Tokenizer.from_file(path)
        # Tokens by age: single bytes, then the results of the merge rules in their order.
        self.ages = {bytes([b]): b for b in range(256)}
        self.halves = [(b, b) for b in range(256)]
        self.joined: dict[int, int] = {}
        for left, right in self.vocabulary.merges:
            a, b = self.ages[left], self.ages[right]
            self.ages[left + right] = self.joined[a << 32 | b] = len(self.halves)
            self.halves.append((a, b))
        # The longest token by its last three bytes: how far back a last token can reach.
        self.reach: dict[bytes, int] = {}
        for token in self.ages:
            if len(token) > 2:
                self.reach[token[-3:]] = max(self.reach.get(token[-3:], 0), len(token))
        self.totals: dict[str, int] = {}
        self.pieces = PieceEncoder(self._totals, room)

    # Words ------------------------------------------------------------------------------------------------------------

    def compatible(self, left: int, right: int) -> bool:
        """True if the rules keep these two tokens apart as they are.

        The younger of the two is undone first; a rule that joins what then touches, and is older than what was undone, would have
        been applied before.
        """
        joined, halves, limit = self.joined.get, self.halves, 1 << 32
        while True:
            rule = joined(left << 32 | right)
            if rule is not None and rule < limit:
                return False
            if left > right:
                limit = left
                left = halves[left][1]
                if left == limit:
                    limit, right = right + 1, halves[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit = right + 1
                right = halves[right][0]
                if right + 1 == limit:
                    limit, left = left, halves[left][1]
                    if left == limit:
                        return True

    def _extend(self, word: bytes, counts: list[int], last: list[int]) -> None:
        """Fill the table of a word from where it ends: ``counts`` and ``last`` hold an entry for every prefix so far."""
        get, reach, compatible = self.ages.get, self.reach.get, self.compatible
        for end in range(len(counts), len(word) + 1):
            for start in range(max(0, end - reach(word[end - 3 : end], 2)) if end > 2 else 0, end):
                token = get(word[start:end])
                if token is not None and (not start or compatible(last[start], token)):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break

    def word_counts(self, word: bytes) -> list[int]:
        """Counts of all byte prefixes of a word, the empty one included."""
        counts, last = [0], [0]
        self._extend(word, counts, last)
        return counts

    def word_totals(self, words_: list[str]) -> None:
        """Keep the counts of whole words. In sorted order, a word goes on from the prefix it shares with the one before."""
        counts, last, before = [0], [0], b""
        if len(self.totals) + len(words_) > self.room:
            self.totals.clear()
        for word in sorted(words_):
            data = word.encode()
            shared, most = 0, min(len(before), len(data))
            while shared < most and before[shared] == data[shared]:
                shared += 1
            del counts[shared + 1 :], last[shared + 1 :]
            self._extend(data, counts, last)
            self.totals[word], before = counts[-1], data

    # Texts ------------------------------------------------------------------------------------------------------------

    def _totals(self, texts: list[str]) -> list[int]:
        cut = list(map(self._words, texts))
        new = {w for ws in cut for w in ws if w not in self.totals}
        if new:
            if len(self.totals) + len(new) > self.room:
                new = {w for ws in cut for w in ws}
            self.word_totals(list(new))
        return [sum(map(self.totals.__getitem__, ws)) for ws in cut]

    def _total(self, text: str) -> int:
        return self._totals([text])[0]

    def _words(self, text: str):
        if settled(text):
            return words(text)
        # The library's own character tables decide what a letter or a number is.
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        parts = self.vocabulary.cut(text)
        return sum(1 if i % 2 else sum(self.pieces.parts(part)) for i, part in enumerate(parts))

    def prefix_counts(self, text: str) -> list[int]:
        """Counts of the prefixes that end before code point 0, 1, ..., len(text)."""
        parts = self.vocabulary.cut(text)
        out = [0]
        for i, part in enumerate(parts):
            base = out[-1]
            if i % 2:
                # Inside a special token the prefix reads as plain text after what came before.
                before = parts[i - 1]
                out += [base - self._total(before) + self._total(before + part[:k]) for k in range(1, len(part))] + [base + 1]
            else:
                out += [base + n for n in self._plain_counts(part)[1:]]
        return out

    def _plain_counts(self, text: str) -> list[int]:
        out, base, blank_from, blank_base = [0], 0, None, 0
        for word in self._words(text):
            data = word.encode()
            table = self.word_counts(data)
            ends = list(accumulate(len(c.encode()) for c in word))
            if word.isspace() and not any("\x1c" <= c <= "\x1f" for c in word):
                if blank_from is None:
                    blank_from, blank_base = len(out) - 1, base
                out += [base + table[e] for e in ends]
            else:
                run = text[blank_from : len(out) - 1] + " " if blank_from is not None and word[0] == " " else None
                own = [base + table[e] for e in ends]
                if run:
                    # A blank that starts a word, seen alone, still belongs to the white space before it.
                    own[0] = blank_base + self.word_counts(run.encode())[-1]
                if word[0] == "'" and len(word) == 3 and word[1:] in ("re", "ve", "ll"):
                    own[1] = base + sum(self.word_counts(w.encode())[-1] for w in self._words(word[:2]))
                out += own
                blank_from = None
            base += table[-1]
            if blank_from is not None:
                # A run of white space is one word as long as nothing follows it.
                run = text[blank_from : len(out) - 1].encode()
                table = self.word_counts(run)
                ends = list(accumulate(len(c.encode()) for c in text[blank_from : len(out) - 1]))
                out[blank_from + 1 :] = [blank_base + table[e] for e in ends]
        return out

    def truncate(self, text: str, budget: int) -> int:
        """The longest prefix, in code points, of at most ``budget`` tokens."""
        counts = self.prefix_counts(text)
        return max(i for i, n in enumerate(counts) if n <= budget)


@lru_cache(maxsize=1)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document; the count is the table's entry for the whole text."""
    small_batches(docs.sparkSession)
    path = path or default_vocabulary()

    def run(batches: Batches) -> Batches:
        own = counter(path)
        for batch in batches:
            texts = str_texts(batch.column(1))
            own.pieces.warm([p for t in texts for p in own.vocabulary.cut(t)[::2]])
            counts = [own.count(t) for t in texts]
            columns = [
                batch.column(0),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array([n > limit for n in counts], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def prefix_tables(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, counts``: the stored table, one count per code point and one for the empty prefix."""
    small_batches(docs.sparkSession)
    path = path or default_vocabulary()

    def run(batches: Batches) -> Batches:
        own = counter(path)
        for batch in batches:
            tables = pa.array([own.prefix_counts(t) for t in str_texts(batch.column(1))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), tables], names=["doc_id", "counts"])

    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, counts array<int>")


def fit_budget(tables: DataFrame, budget: int) -> DataFrame:
    """``doc_id, n_tokens, cut``: whole count, and the longest prefix of at most ``budget`` tokens, from stored tables alone."""
    fitting = f"filter(sequence(0, size(counts) - 1), i -> counts[i] <= {int(budget)})"
    return tables.selectExpr("doc_id", "cast(element_at(counts, -1) as bigint) AS n_tokens", f"element_at({fitting}, -1) AS cut")
