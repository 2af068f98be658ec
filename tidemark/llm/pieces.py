"""SentencePiece encoding and decoding by a forward pass that words with a common beginning share.

A text is marked (blanks become U+2581, one is put in front) and cut into words where no piece can
reach across. The distinct words of a run are sorted, which lays them out as a trie in depth-first
order: going from one word to the next, the forward table up to their common prefix stays and only
the rest is computed. At every prefix the table has the best last piece and its score.

For a unigram model the best is the highest sum of piece scores (Viterbi). A BPE model has its own
order of merges instead of sums: of the pieces that end at a prefix exactly one goes with the piece
before it, in the sense that merging the two pieces' characters by the model's order gives just these
two; as merges inside and across neighbours do not depend on what stands farther away, the pieces
chosen this way are those of merging the whole text.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import arrow_runs, columns, fresh, modest_batches

MARK = "▁"
#: Words of a model without pieces across marks, line ends or tabs, and without punctuation apart.
PLAIN_WORDS = f"{MARK}*[^{MARK}\n\t\r]+|{MARK}+|[\n\t\r]"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed values of the model format: piece kinds and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class PieceModel:
    """What a task needs of a model; its size is that of the vocabulary."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    texts: list[bytes]
    unknown_id: int
    bpe: bool
    prefix: bool
    squeeze: bool
    words: str


def load(path: str = DEFAULT_MODEL) -> PieceModel:
    """Read a model file. Its normalisation must be the identity, so that decoding gives the text back."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    return from_proto(m)


def from_proto(m) -> PieceModel:
    norm, kind = m.normalizer_spec, m.trainer_spec.model_type
    if norm.precompiled_charsmap or kind not in (UNIGRAM, BPE) or m.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only unigram and BPE models without a character map or suffix marks are supported")
    if any(p.type == USER_DEFINED for p in m.pieces):
        raise ValueError("models with user-defined symbols are not supported")
    usable = [(i, p) for i, p in enumerate(m.pieces) if p.type == NORMAL]
    bytes_of = {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
    texts = [bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else b"" if p.type == CONTROL
             else " ⁇ ".encode() if p.type == UNKNOWN else p.piece.replace(MARK, " ").encode() for p in m.pieces]
    long = [p.piece for _, p in usable if len(p.piece) > 1]
    # No piece reaches across two characters that stand side by side in none. Words are cut so before
    # marks, before punctuation that never follows anything else, and around line ends and tabs.
    beside = {p[i:i + 2] for p in long for i in range(len(p) - 1)}
    alone = "".join(c for c in "\n\t\r" if not any(c in pair for pair in beside))
    points = set(string.punctuation)
    while bad := {y for x, y in beside if y in points and x not in points and x != MARK}:
        points -= bad
    points = "".join(sorted(points))
    p, rest = re.escape(points), f"[^{MARK}{alone}{re.escape(points)}]"
    words = f"{MARK}*[{p}]*{rest}+|{MARK}*[{p}]+|{MARK}+" if points else f"{MARK}*{rest}+|{MARK}+"
    if any(pair[1] == MARK and pair[0] != MARK for pair in beside):
        words = f"[^{alone}]+" if alone else "(?s:.+)"
    return PieceModel(
        {p.piece: i for i, p in usable}, {p.piece: p.score for _, p in usable}, [bytes_of[b] for b in range(256)] if len(bytes_of) == 256 else [],
        texts, next(i for i, p in enumerate(m.pieces) if p.type == UNKNOWN), kind == BPE, norm.add_dummy_prefix,
        norm.remove_extra_whitespaces, words + (f"|[{alone}]" if alone else ""))


class Encoder:
    """Encodes words and keeps what it found in two generations of ``most_words`` words (and as many pairs): what
    was asked for since the last change of generation stays. Words longer than ``long_word`` are not kept, those
    longer than ``alone`` are walked by themselves, in memory of some twenty bytes a character."""

    def __init__(self, model: PieceModel, most_words: int = 200_000, long_word: int = 64, alone: int = 1000):
        self.model, self.most_words, self.long_word, self.alone = model, most_words, long_word, alone
        self.split = re.compile(model.words).findall
        self.plain = model.words == PLAIN_WORDS and model.prefix and not model.squeeze
        self.odd = re.compile(rf"[{MARK}\t\r]|\A[ \n]|[ \n]\Z|\n[ \n]| \n").search
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.older_pairs: dict[tuple[str, str], bool] = {}
        self.past: dict[str, list[tuple[float, str, str]] | None] = {}
        self.floor = min(model.scores.values(), default=0.0) - 10
        self.reach = max(map(len, model.ids), default=1)
        self.trie: dict = {}
        for piece in model.ids:
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = piece

    def marked(self, text: str) -> str:
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.model.prefix else "") + text.replace(" ", MARK)

    def goes_with(self, left: str, right: str) -> bool:
        """Whether merging the characters of both by the model's order gives ``left`` and ``right``."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.older_pairs.get((left, right))
            if known is None:
                known = self._merges(left, right)
            if len(self.pairs) > self.most_words:
                self.older_pairs = dict(self.pairs)
                self.pairs.clear()  # the same object: a walk holds it
            self.pairs[left, right] = known
        return known

    def _past(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The merges that make ``piece`` of its characters, as score and first and last part after it;
        None if they do not end in one part. The best score goes first, of equal ones the leftmost."""
        if piece not in self.past:
            scores, parts, steps = self.model.scores, list(piece), []
            while len(parts) > 1:
                found = [scores.get(x + y) for x, y in zip(parts, parts[1:])]
                best = max((f for f in found if f is not None), default=None)
                if best is None:
                    break
                at = found.index(best)
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                steps.append((best, parts[0], parts[-1]))
            self.past[piece] = steps if len(parts) == 1 else None
        return self.past[piece]

    def _merges(self, left: str, right: str) -> bool:
        """The merges of both sides run in the order of their scores; a merge across the border that comes first parts them."""
        mine, theirs, scores = self._past(left) if left else [], self._past(right), self.model.scores
        if mine is None or theirs is None:
            return False
        if not left:
            return True
        i = j = 0
        x, y = left[-1], right[0]
        while True:
            across = scores.get(x + y)
            a = mine[i][0] if i < len(mine) else None
            b = theirs[j][0] if j < len(theirs) else None
            if across is not None and (a is None or across > a) and (b is None or across >= b):
                return False
            if a is not None and (b is None or a >= b):
                x, i = mine[i][2], i + 1
            elif b is not None:
                y, j = theirs[j][1], j + 1
            else:
                return True

    def encode_sorted(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Piece ids of each word, packed; ``words`` are distinct and sorted, so neighbours share their beginnings."""
        ids, walk = self.model.ids, self._walk_merges if self.model.bpe else self._walk_scores
        before = ""
        # By prefix length: where its last piece begins, that piece, the score, and the trie nodes still open.
        table: tuple[list, list, list, list] = [0], [""], [0.0], [[]]
        for word in words:
            if len(word) > self.alone:
                yield word, self._long_word(word)
                continue
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            for column in table:
                del column[same + 1:]
            walk(word, same, *table)
            start, piece = table[0], table[1]
            out, i = [], len(word)
            while i > 0:
                out.append(piece[i])
                i = start[i]
            out.reverse()
            try:
                yield word, array("i", [ids[x] for x in out]).tobytes()
            except KeyError:
                yield word, array("i", chain.from_iterable(map(self._ids, out))).tobytes()
            before = word

    def _walk_merges(self, word: str, same: int, start: list, piece: list, score: list, open_at: list) -> None:
        """Extend the table from prefix length ``same``: the longest piece that goes with the one before it."""
        root, pairs, goes_with = self.trie, self.pairs, self.goes_with
        now = open_at[same]
        for i in range(same, len(word)):
            c, still = word[i], []
            best_start, best_piece = i, None
            for begin, node in now:
                node = node.get(c)
                if node is not None:
                    still.append((begin, node))
                    if best_piece is None:
                        found = node.get("")
                        if found is not None:
                            ok = pairs.get((piece[begin], found))
                            if ok or ok is None and goes_with(piece[begin], found):
                                best_start, best_piece = begin, found
            node = root.get(c)
            if node is not None:
                still.append((i, node))
            start.append(best_start)
            piece.append(best_piece or c)
            open_at.append(still)
            now = still

    def _walk_scores(self, word: str, same: int, start: list, piece: list, score: list, open_at: list) -> None:
        """The same by the highest sum of scores."""
        root, scores = self.trie, self.model.scores
        now = open_at[same]
        for i in range(same, len(word)):
            c, still = word[i], []
            best_start, best_piece, best = i, c, score[i] + self.floor
            node = root.get(c)
            for begin, node in now if node is None else [*now, (i, root)]:
                node = node.get(c)
                if node is not None:
                    still.append((begin, node))
                    found = node.get("")
                    if found is not None and score[begin] + scores[found] > best:
                        best_start, best_piece, best = begin, found, score[begin] + scores[found]
            start.append(best_start)
            piece.append(best_piece)
            score.append(best)
            open_at.append(still)
            now = still

    def _long_word(self, word: str, step: int = 4096) -> bytes:
        """The same walk in steps. Only what a piece can reach back to stays in lists; of all other prefixes the
        last piece is kept as two numbers."""
        walk, reach = self._walk_merges if self.model.bpe else self._walk_scores, self.reach
        width, last = array("i", [0]), array("i", [0])  # by prefix length: signs and id of the last piece, -1 without id
        start, piece, score, open_at = [0], [""], [0.0], [[]]
        for at in range(0, len(word), step):
            back = len(start) - 1  # positions that the lists hold before this step
            walk(word[at - back:at + step], back, start, piece, score, open_at)
            for i in range(back + 1, len(start)):
                width.append(i - start[i])
                last.append(self.model.ids.get(piece[i], -1))
            shift = max(0, len(start) - 1 - reach)
            if shift:
                begins = [[(b - shift, node) for b, node in open_at[-1]]]
                start = [max(0, b - shift) for b in start[shift:]]
                piece, score, open_at = piece[shift:], score[shift:], [[]] * (len(start) - 1) + begins
        out, i = array("i"), len(word)
        while i > 0:
            if last[i] >= 0:
                out.append(last[i])
            else:
                out.extend(reversed(self._ids(word[i - width[i]:i])))
            i -= width[i]
        out.reverse()
        return out.tobytes()

    def _ids(self, piece: str) -> tuple[int, ...]:
        found = self.model.ids.get(piece)
        if found is not None:
            return (found,)
        if self.model.byte_ids:
            return tuple(self.model.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
        return (self.model.unknown_id,)

    def _cut(self, text: str) -> list[str]:
        """Words of a text. Where each mark begins a word, as in plain prose, splitting at blanks is enough."""
        if self.plain and "  " not in text and not self.odd(text):
            if "\n" in text:
                text = text.replace("\n", " \n ")
                return self.marked(text).replace(f"{MARK}\n{MARK}", " \n ").replace(MARK, f" {MARK}").split(" ")
            return self.marked(text).replace(MARK, f" {MARK}").split(" ")
        return self.split(self.marked(text))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self._cut(t) for t in texts]
        fresh = set(filterfalse(self.known.__contains__, chain.from_iterable(cut)))
        if self.older:
            again = fresh.intersection(self.older)
            self.known.update((w, self.older[w]) for w in again)
            fresh -= again
        self.known[""] = b""
        fresh = sorted(fresh.difference([""]))
        self.known.update(self.encode_sorted(fresh))
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32) for words in cut]
        for w in fresh:
            if len(w) > self.long_word:
                del self.known[w]
        if len(self.known) > self.most_words:
            self.older, self.known = self.known, {}
        return out


def _text_of(model: PieceModel, ids: list) -> str:
    """Ids outside the vocabulary and null ids read as unknown."""
    texts, unknown = model.texts, model.texts[model.unknown_id]
    try:
        whole = b"".join([texts[i] for i in ids]) if not ids or min(ids) >= 0 else None
    except (IndexError, TypeError):
        whole = None
    if whole is None:
        whole = b"".join([texts[int(i)] if i is not None and i == i and 0 <= i < len(texts) else unknown for i in ids])
    if model.prefix and whole.startswith(b" "):
        whole = whole[1:]
    return whole.decode("utf-8", "replace")


def encode_column(docs: DataFrame, model: PieceModel, text: str = "text", out: str = "token_ids", checked: str | None = None,
                  most_words: int = 200_000, run_bytes: int = 1 << 21) -> DataFrame:
    """Add ``out``, the piece ids of whole texts; null stays null, an empty text has none. With ``checked``
    add a column that says whether decoding gives the text back. All rows and columns are kept. A task's memory
    follows ``most_words`` (see ``Encoder``) and ``run_bytes``, the text that is encoded at once; the ids do not."""
    modest_batches(docs.sparkSession, size=8 * run_bytes)
    fields = [f for f in docs.schema if f.name not in (out, checked)]
    names = [f.name for f in fields]
    at, inside = names.index(text), [f"c{i}" for i in range(len(fields))]  # names may hold dots
    added = [T.StructField(out, T.ArrayType(T.IntegerType()))] + ([T.StructField(checked, T.BooleanType())] if checked else [])
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(inside, fields)] + added)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = Encoder(model, most_words)
        for batch in batches:
            for part, texts in arrow_runs(batch, inside[at], run_bytes):
                ids = own.encode(texts)
                null = part.column(at).is_null()
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                added = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids), pa.int32()), mask=null)]
                if checked:
                    same = [_text_of(model, x.tolist()) == t for x, t in zip(ids, texts)]
                    added.append(pa.array(same, pa.bool_(), mask=null.to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=schema.names)

    plain = docs.select(*[c for c, f in zip(columns(docs), docs.schema) if f.name not in (out, checked)]).toDF(*inside)
    return plain.mapInArrow(run, schema).toDF(*names, *schema.names[len(names):])


def decoder(model: PieceModel):
    """A column function: piece ids to text; null stays null."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            plain = (x if x is None else x.tolist() if hasattr(x, "tolist") else x for x in ids)
            yield pd.Series([None if x is None else _text_of(model, x) for x in plain], index=ids.index, dtype=object)

    return decode


def decode_column(docs: DataFrame, model: PieceModel, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    return docs.withColumn(out, decoder(model)(F.col(ids)))


def op2_pieces(docs: DataFrame, path: str = DEFAULT_MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens, token_ids, round_trip (decoding gives the text back).

    A null text has null ids, no tokens and null round_trip. Only a text that itself holds the
    mark U+2581 does not come back, as the format writes blanks so.
    """
    coded = encode_column(docs.select("doc_id", "text"), load(path), checked="round_trip")
    return coded.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size("token_ids")).alias("n_tokens"), "token_ids", "round_trip")


def tokenised(docs: DataFrame, path: str = DEFAULT_MODEL) -> DataFrame:
    """Documents as token sequences: all columns but the text, and the ids as ``token_ids`` (with a
    leading underscore if that name is taken). It runs after other stages in executors whose memory those have
    grown, so it remembers fewer words than ``op2_pieces`` does and encodes less text at once."""
    return encode_column(docs, load(path), out=fresh(docs, "token_ids"), most_words=40_000, run_bytes=1 << 19).drop("text")
