"""SentencePiece encoding and decoding by a streaming Viterbi search.

The pieces of a SentencePiece model file make a unigram lattice over the text
(space written as U+2581, one put in front); the best path has the largest sum
of piece scores. BPE model files carry no probabilities, only merge ranks, so
a piece of rank r (from 1) scores -log(r + 1), a Zipf estimate; files with
probabilities use them as they are. A character that starts no piece is
spelled in byte pieces, each scoring below any other piece.

The search keeps one score and one backpointer for each position of a window
bounded by the longest piece. Whenever all open paths go back through one
boundary, the ids before it are final and are committed, so memory does not
depend on the length of the text. Ties go to the longest last piece.

Decoding joins the pieces, byte pieces as UTF-8, and takes off the first space:
``decode(encode(t)) == t``; a U+2581 of the text itself goes by its bytes.

Null texts are encoded as empty ones (no ids); repeated rows give repeated
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from array import array

import numpy as np
from pyspark.sql import DataFrame

from orrery.llm.common import id_text_columns, in_small_batches

SPACE = "▁"
#: Scores are whole multiples of 1 / FIXED: sums are exact wherever they start.
FIXED = 1 << 20
UNREACHED = -(1 << 62)
SCHEMA = "doc_id long, ids array<int>, round_trip boolean"


class Pieces:
    """The lattice of a model: piece -> (score, id) and byte pieces."""

    def __init__(self, pieces: list, bytes_at: dict, byte_score: int):
        self.of = {p: (s, i) for p, s, i in pieces}
        self.bytes_at, self.byte_score = bytes_at, byte_score
        self.longest = max(map(len, self.of), default=1)

    def text_of(self) -> dict:
        return {i: p.replace(SPACE, " ") for p, (_, i) in self.of.items()}

    def trie(self) -> dict:
        """Character -> (next characters, score or None, id)."""
        root: dict = {}
        for p in sorted(self.of):  # a prefix comes before what it begins
            level = root
            for c in p[:-1]:
                level = level.setdefault(c, ({}, None, 0))[0]
            level[p[-1]] = ({}, *self.of[p])
        return root


def load_pieces(model_file: str) -> Pieces:
    """Read a model file (on the driver; the pieces go to tasks by value)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    normal, bytes_at = [], {}
    for i in range(m.vocab_size()):
        p = m.id_to_piece(i)
        if m.is_byte(i):
            bytes_at[int(p[1:-1], 16)] = i
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            normal.append((p, m.get_score(i), i))
    ranks = all(float(s).is_integer() for _, s, _ in normal)  # a BPE file: minus the merge rank
    if ranks:
        worst = min((s for _, s, _ in normal if s > -1e8), default=-1.0)
        normal = [(p, -math.log(2.0 - max(s, worst)), i) for p, s, i in normal]
    normal = [(p, round(s * FIXED), i) for p, s, i in normal]
    low = min((s for _, s, _ in normal), default=0)
    return Pieces(normal, bytes_at, low - 10 * FIXED)


class StreamingViterbi:
    """Best path over characters that arrive in stretches.

    Pieces are tried from every position that has all it may need in the
    buffer (``max_piece`` characters, or the end of the text). The boundaries
    reached so far at or after the next such position are the open ones: every
    path that may still win ends in one of them."""

    def __init__(self, pieces: Pieces):
        self.p, self.root = pieces, pieces.trie()
        self.alone = frozenset(p for p in pieces.of if len(p) == 1)

    def encode(self, text: str, step: int = 256) -> list:
        """Ids of ``text``, read ``step`` characters at a time."""
        out: list = []
        buf, at, score, start, piece = "", 0, [0], [-1], [0]
        for lo in range(0, len(text), step):
            more = text[lo:lo + step]
            buf += more
            score += [UNREACHED] * len(more)
            start += [-1] * len(more)
            piece += [0] * len(more)
            last = lo + step >= len(text)
            at = self._advance(buf, at, score, start, piece, len(buf) if last else len(buf) - self.p.longest + 1)
            buf, at, score, start, piece = self._commit(buf, at, score, start, piece, out)
        return out

    def _advance(self, buf, at, score, start, piece, until):
        root = self.root
        for at in range(at, until):
            here, level, end = score[at], root, at
            for c in buf[at:]:
                node = level.get(c)
                if node is None:
                    break
                level, value, i = node
                end += 1
                if value is not None and here + value > score[end]:
                    score[end], start[end], piece[end] = here + value, at, i
            if buf[at] not in self.alone:  # no piece itself: it can go by its bytes
                value = here + len(buf[at].encode("utf-8")) * self.p.byte_score
                if value > score[at + 1]:
                    score[at + 1], start[at + 1], piece[at + 1] = value, at, -1
        return max(at, until) if until > 0 else at

    def _commit(self, buf, at, score, start, piece, out):
        """Emit the ids before the latest boundary that all open paths share."""
        if at == len(buf):
            shared = at
        else:
            open_at = {e for e in range(at, len(score)) if start[e] >= 0 or e == 0}
            while len(open_at) > 1:
                far = max(open_at)
                open_at.discard(far)
                open_at.add(start[far])
            shared = open_at.pop()
        ids, end = [], shared
        while end > 0:
            if piece[end] >= 0:
                ids.append(piece[end])
            else:
                ids.extend([self.p.bytes_at[b] for b in reversed(buf[start[end]:end].encode("utf-8"))])
            end = start[end]
        ids.reverse()
        out += ids
        if not shared or at == len(buf):
            return (buf, at, score, start, piece) if not shared else ("", 0, [0], [-1], [0])
        base = score[shared]
        return (buf[shared:], at - shared, [s - base if s > UNREACHED else s for s in score[shared:]],
                [-1] + [b - shared if b >= 0 else b for b in start[shared + 1:]], [0, *piece[shared + 1:]])


class Encoder:
    """Whole texts. Every path converges between two characters that stand
    side by side in no piece: before a word, as no piece holds a space after
    another character, at most line ends, and inside many words. What lies
    between two such boundaries always gets the same ids; those of the last
    ``remembered`` different stretches are kept."""

    def __init__(self, pieces: Pieces, remembered: int = 1 << 18, longest_kept: int = 64):
        self.search, self.kept, self.after_space = StreamingViterbi(pieces), {}, {}
        self.remembered, self.longest_kept = remembered, longest_kept
        self.pairs = frozenset(p[k:k + 2] for p in pieces.of for k in range(len(p) - 1))
        self.words = not any(SPACE in p.lstrip(SPACE) for p in pieces.of)
        self.lines = not any("\n" in p for p in pieces.of)
        self.line_end = self._bytes("\n") if self.lines else b""

    def _bytes(self, c: str) -> bytes:
        return np.array([self.search.p.bytes_at[b] for b in c.encode("utf-8")], np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        parts: list = []
        for k, part in enumerate(text.split(SPACE) if text else ()):
            if k:  # the text's own U+2581 is spelled in bytes, so that it comes back
                parts.append(self._bytes(SPACE))
            for i, line in enumerate(part.split("\n") if self.lines else [part]):
                if i:
                    parts.append(self.line_end)
                self._line((" " if k == i == 0 else "") + line, parts)
        return np.frombuffer(b"".join(parts), np.int32)

    def _line(self, text: str, parts: list) -> None:
        if not self.words:
            parts.append(self._ids(text.replace(" ", SPACE)))
            return
        first, *rest = text.split(" ")
        if first:
            parts.append(self._ids(first))
        if "" in rest:
            space = ""  # a run of spaces goes with the word after it
            for word in rest:
                if word:
                    parts.append(self._ids(space + SPACE + word))
                space = "" if word else space + SPACE
            if space:
                parts.append(self._ids(space))
        else:
            known, new = self.after_space.get, self._after_space
            parts += [known(word) or new(word) for word in rest]

    def _after_space(self, word: str) -> bytes:
        ids = self._ids(SPACE + word)
        if len(word) <= self.longest_kept:
            if len(self.after_space) >= self.remembered:
                self.after_space.clear()
            self.after_space[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        """The ids of a stretch between boundaries, as the bytes of 32-bit numbers."""
        ids = self.kept.get(word)
        if ids is None:
            pairs = self.pairs
            cuts = [k for k in range(1, len(word)) if word[k - 1:k + 1] not in pairs]
            if cuts:
                return b"".join([self._ids(word[a:b]) for a, b in zip([0, *cuts], [*cuts, len(word)])])
            ids = array("i", self.search.encode(word)).tobytes()
            if len(word) <= self.longest_kept:
                if len(self.kept) >= self.remembered:
                    self.kept.clear()
                self.kept[word] = ids
        return ids


def decode(ids: list, text_of: dict, byte_of: dict) -> str:
    try:
        return "".join([text_of[i] for i in ids])[1:]
    except KeyError:  # byte pieces
        return b"".join([bytes([byte_of[i]]) if i in byte_of else text_of[i].encode("utf-8") for i in ids]).decode("utf-8")[1:]


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ids of its whole text, and
    whether they decode to it."""
    pieces = load_pieces(model_file)

    def run(batches):
        import pyarrow as pa

        enc, text_of, byte_of = Encoder(pieces), pieces.text_of(), {i: b for b, i in pieces.bytes_at.items()}
        for b in in_small_batches(batches, 2 << 20):
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids = [enc.encode(t) for t in texts]
            same = [decode(i.tolist(), text_of, byte_of) == t for i, t in zip(ids, texts, strict=True)]
            flat = np.concatenate(ids)
            offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(same)], ["doc_id", "ids", "round_trip"])

    return id_text_columns(docs).mapInArrow(run, SCHEMA)


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of each row of (doc_id, ids)."""
    pieces = load_pieces(model_file)

    def run(batches):
        import pyarrow as pa

        text_of, byte_of = pieces.text_of(), {i: b for b, i in pieces.bytes_at.items()}
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [decode(x, text_of, byte_of) if x is not None else None for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
