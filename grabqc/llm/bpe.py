"""Byte-level BPE through a sentencepiece model that is written from the vocabulary.

The model's pieces are the vocabulary's byte strings, each byte mapped to a letter of its own;
a piece's score is its negative rank, so the model merges in the order of the ranks. It
normalises nothing. A text is cut into pre-tokens by the vocabulary's pattern, and each is
encoded by itself. Decoding maps ids back to byte strings.

A text is first cut at single spaces, where the pattern always cuts, and equal cuts are encoded
once per task; the store of known cuts is emptied when it would pass ``remember`` entries.

Nulls: a null text is empty and has no tokens; a null id stays null. Texts of any length are
encoded whole. Repeated rows are encoded each; an empty table gives an empty result.
"""

import base64
import gc
import hashlib
from array import array
from itertools import accumulate, chain

import numpy as np
import regex
import sentencepiece
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_proto

from grabqc.llm.common import map_batches, parts, utf8

# White space as the pattern's engine has it (Unicode White_Space). Fixed values.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = "".join(c for c in map(chr, range(0x3001)) if regex.match(f"[{SPACE}]", c))
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
FIRST_LETTER = 0x4E00


def read_ranks(path):
    """Byte strings of a rank file, in the order of their ranks."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return sorted(ranks, key=ranks.get)


def letters(data):
    """One letter for each byte. No letter is one that a model treats in its own way."""
    return "".join(map(chr, (FIRST_LETTER + b for b in data)))


def model_bytes(pieces):
    """A sentencepiece BPE model of the given byte strings, with ids equal to ranks."""
    model = model_proto.ModelProto()
    kind = model_proto.ModelProto.SentencePiece
    for rank, piece in enumerate(pieces):
        model.pieces.add(piece=letters(piece), score=-float(rank), type=kind.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=kind.UNKNOWN)
    trainer = model.trainer_spec
    trainer.model_type, trainer.vocab_size = trainer.BPE, len(pieces) + 1
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(pieces), -1, -1, -1
    rule = model.normalizer_spec
    rule.name, rule.add_dummy_prefix, rule.remove_extra_whitespaces, rule.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


class Codec:
    """Encodes texts to ids and ids to bytes. ``pattern`` cuts a text into pre-tokens."""

    def __init__(self, pieces, pattern, remember=400_000, model=None):
        self.pieces, self.remember = pieces, remember
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model or model_bytes(pieces))
        pattern = pattern.replace(r"[^\s", "[^" + SPACE).replace(r"\s", "[" + SPACE + "]").replace(r"\S", "[^" + SPACE + "]")
        self.pretokens = regex.compile(pattern).findall
        self.letter = {b: chr(FIRST_LETTER + b) for b in range(256)}
        self.known, self.words = {}, {}

    def pack(self, cuts):
        """Packed ids of each cut, a string whose pre-tokens depend on nothing around it."""
        words, split = self.words, []
        for cut in cuts:
            stem = cut.rstrip(MARKS)
            if cut[:1] == " " and stem[1:].isalpha():  # the common case, without the pattern
                split.append((stem, cut[len(stem):]) if len(stem) < len(cut) else (stem,))
            else:
                split.append(self.pretokens(cut))
        new = list(set(chain.from_iterable(split)).difference(words))
        ids = self.model.encode([utf8(p).decode("latin-1").translate(self.letter) for p in new], num_threads=1)
        flat = array("I", chain.from_iterable(ids)).tobytes()
        ends = list(accumulate(map(len, ids), initial=0))
        words.update(zip(new, (flat[4 * a:4 * b] for a, b in zip(ends, ends[1:]))))
        return [words[p[0]] if len(p) == 1 else b"".join([words[x] for x in p]) for p in split]

    def encode(self, texts):
        """Ids of each text as little-endian unsigned 32-bit integers, one after the other.

        A text is cut before each space. The pattern cuts there too, unless other white space
        is next to that space; such a text is encoded in one piece.
        """
        known = self.known
        split = [(t or "").split(" ") for t in texts]
        new = set().union(*[s[1:] for s in split]).difference(known)
        if len(known) + len(new) > self.remember:
            known.clear()
            new = set().union(*[s[1:] for s in split])
        safe = [c for c in new if c and len(c.strip(SPACES)) == len(c)]
        known.update(dict.fromkeys(new))
        known.update(zip(safe, self.pack([" " + c for c in safe])))
        first = self.pack([s[0] for s in split])
        out = []
        for text, cuts, start in zip(texts, split, first):
            ids = [start, *map(known.__getitem__, cuts[1:])]
            if None in ids or cuts[0][-1:] in SPACES and cuts[0]:
                out.extend(self.pack([text]))
            else:
                out.append(b"".join(ids))
        if len(self.words) > self.remember:
            self.words.clear()
        for cut in [c for c in new if len(c) > 64]:
            del known[cut]
        return out

    def decode(self, ids):
        """Bytes of packed ids."""
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode(docs, path, pattern, id_col="doc_id", text_col="text"):
    """Each row's id and its ``ids``, packed as little-endian unsigned 32-bit integers."""
    def start():
        codec = Codec(read_ranks(path), pattern)
        return lambda ids, texts: (ids, [p for a, b in parts(texts) for p in codec.encode(texts[a:b])])

    return map_batches(docs, [id_col, text_col], start, T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("ids", T.BinaryType())]))


def decode(encoded, path, id_col="doc_id", ids_col="ids"):
    """Each row's id and the bytes that its ids stand for."""
    def start():
        pieces = read_ranks(path)
        codec = Codec.__new__(Codec)
        codec.pieces = pieces
        return lambda ids, packed: (ids, [codec.decode(p or b"") for p in packed])

    return map_batches(encoded, [id_col, ids_col], start, T.StructType([
        T.StructField("doc_id", encoded.schema[id_col].dataType), T.StructField("decoded", T.BinaryType())]))


def digests(docs, path, pattern, id_col="doc_id", text_col="text"):
    """Per row: id, number of tokens, and digests of the packed ids and of what they decode to."""
    def start():
        codec = Codec(read_ranks(path), pattern)
        gc.disable()  # many small strings and no cycles

        def step(ids, texts):
            tokens, packed, back = [], [], []
            for ids_of_text in (packed_ids for a, b in parts(texts) for packed_ids in codec.encode(texts[a:b])):
                tokens.append(len(ids_of_text) // 4)
                packed.append(hashlib.sha256(ids_of_text).hexdigest())
                back.append(hashlib.sha256(codec.decode(ids_of_text)).hexdigest())
            return ids, tokens, packed, back

        return step

    return map_batches(docs, [id_col, text_col], start, T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))
