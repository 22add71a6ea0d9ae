"""SentencePiece encoding and decoding by suffix-array matching."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.hashing import Sequence, mix, pieces, text_buffer

SPACE = "▁"
#: Code points of the longest piece that is matched.
LONGEST = 16
#: Segments whose tokens a worker remembers.
REMEMBERED = 1_000_000
#: Code points that are cut into segments at a time.
CHUNK = 1 << 18
#: New segments that are indexed together.
INDEXED = 1 << 15


#: Session setting that names the model file.
MODEL = "spark.sheen.tokenizer.model"


def default_model(spark=None) -> str:
    """The model file that the session's ``MODEL`` setting names, else the public 32k model of
    this machine's tokenizer package. Only the driver reads the file."""
    path = spark.conf.get(MODEL, None) if spark is not None else None
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str) -> dict:
    """Pieces, scores and byte ids of a BPE model file. They are plain values of a bounded size
    (the vocabulary), so tasks get them from the driver and need no model file."""
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    plain = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    if any(len(m.id_to_piece(i)) > LONGEST for i in plain):
        raise ValueError(f"a piece of more than {LONGEST} code points")
    byte = {int(m.id_to_piece(i)[3:5], 16): i for i in range(n) if m.is_byte(i)}
    return {"size": n, "ids": plain, "pieces": [m.id_to_piece(i) for i in plain],
            "scores": [m.get_score(i) for i in plain], "unknown": m.unk_id(),
            "bytes": [byte.get(b, m.unk_id()) for b in range(256)]}


class Encoder:
    """Encodes the texts of Arrow batches exactly as the model's merges do.

    A merge joins two adjacent symbols whose strings together are a piece, best score first,
    leftmost first. Two facts make this a shortest-path walk. No merge crosses a place whose
    two characters stand next to each other in no piece, so a text falls into segments that
    are encoded on their own, each distinct one once. And the last token of the encoding of a
    prefix is the one piece ending there that stays apart from the last token before it, so
    edges (piece occurrences), sorted by their end, are relaxed from left to right.
    """

    def __init__(self, model: dict):
        self.size, self.unknown, self.byte_ids = model["size"], model["unknown"], np.array(model["bytes"])
        self.score = dict(zip(model["pieces"], model["scores"]))
        self.piece_ids = np.array(model["ids"])
        chars = sorted({c for p in model["pieces"] for c in p})
        if len(chars) > 0xFFFE:
            raise ValueError("more characters than 16 bits number")
        self.chars = ["", *chars]
        self.classes = np.zeros(0x110000, np.uint16)
        self.classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        number = {c: k + 1 for k, c in enumerate(chars)}
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        self.text = {int(i): p for i, p in zip(model["ids"], model["pieces"])}
        single = {p: i for i, p in zip(model["ids"], model["pieces"]) if len(p) == 1}
        # a character that is no piece itself has a token of its own behind the vocabulary
        self.single = np.array([0] + [single.get(c, self.size + k + 1) for k, c in enumerate(chars)])
        self.text.update({self.size + k + 1: c for k, c in enumerate(chars)})
        keys = np.zeros((len(model["pieces"]), LONGEST), ">u2")
        self.lengths = np.array([len(p) for p in model["pieces"]])
        for k, p in enumerate(model["pieces"]):
            keys[k, :len(p)] = [number[c] for c in p]
            for a, b in zip(p, p[1:]):
                self.joined[number[a], number[b]] = True
        past = np.arange(LONGEST)[None, :] >= self.lengths[:, None]
        kind = f"S{2 * LONGEST}"
        self.low = np.ascontiguousarray(keys).view(kind).ravel()
        self.high = np.ascontiguousarray(np.where(past, np.array(0xFFFF, ">u2"), keys).astype(">u2")).view(kind).ravel()
        self.pair_keys, self.pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self._forget()
        # decoding: the bytes of each token
        data = [b"" for _ in range(self.size)]
        for i, p in zip(model["ids"], model["pieces"]):
            data[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(model["bytes"]):
            if i != self.unknown:
                data[i] = bytes([b])
        self.token_bytes = np.frombuffer(b"".join(data), np.uint8)
        self.token_at = np.concatenate(([0], np.cumsum([len(d) for d in data])))

    def _forget(self):
        self.known, self.known_at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.known_n, self.tokens = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def merged(self, text: str) -> list[str]:
        """The symbols that the merges make of a short text."""
        symbols, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def _fits(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether ``token`` stays apart from the token ``before`` it (-1: the segment starts)."""
        pair = (before.astype(np.int64) + 1) * (2 * self.size + len(self.chars)) + token
        key, inverse = np.unique(pair, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pair_keys, key), max(len(self.pair_keys) - 1, 0))
        new = self.pair_keys[at] != key if len(self.pair_keys) else np.ones(len(key), bool)
        if new.any():
            fits = []
            for k in key[new].tolist():
                b, t = divmod(k, 2 * self.size + len(self.chars))
                parts = ([self.text[b - 1]] if b else []) + [self.text[t]]
                fits.append(self.merged("".join(parts)) == parts)
            keys = np.concatenate((self.pair_keys, key[new]))
            order = np.argsort(keys)
            self.pair_keys, self.pair_fits = keys[order], np.concatenate((self.pair_fits, fits)).astype(bool)[order]
            at = np.searchsorted(self.pair_keys, key)
        return self.pair_fits[at][inverse]

    def _encode_segments(self, chars: np.ndarray, off: np.ndarray):
        """Tokens of segments of character classes (all known): flat, and their counts."""
        n = len(chars)
        begin = np.repeat(off[:-1], np.diff(off))
        finish = np.repeat(off[1:], np.diff(off))
        padded = np.concatenate((chars, np.zeros(LONGEST, chars.dtype)))
        suffix = np.zeros((n, LONGEST), ">u2")
        for k in range(LONGEST):
            suffix[:, k] = np.where(np.arange(n) + k < finish, padded[k:k + n], 0)
        words = suffix.view(">u8").astype(np.uint64)
        order = np.lexsort(words.T[::-1])  # the suffix array, to the depth of the longest piece
        index = suffix[order].view(f"S{2 * LONGEST}").ravel()
        first, last = np.searchsorted(index, self.low, "left"), np.searchsorted(index, self.high, "right")
        count = np.maximum(last - first, 0)
        hit = np.repeat(np.arange(len(count)), count)
        rank = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        start, length, token = order[rank], self.lengths[hit], self.piece_ids[hit]
        extra = np.flatnonzero(self.single[chars] >= self.size)
        start, length = np.append(start, extra), np.append(length, np.ones(len(extra), np.int64))
        token = np.append(token, self.single[chars[extra]])
        end = start + length - 1
        depth = end - begin[start]
        by = np.argsort(depth, kind="stable")
        start, length, token, end = start[by], length[by], token[by], end[by]
        edge = np.searchsorted(depth[by], np.arange(int(depth.max(initial=-1)) + 2))
        state, size = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            s, t = start[a:b], token[a:b]
            inner = s > begin[s]
            before = np.where(inner, state[s - 1], -1)
            ok = self._fits(before, t)
            e = end[a:b][ok]
            state[e], size[e] = t[ok], length[a:b][ok]
        at, steps = off[1:] - 1, []
        live = np.arange(len(off) - 1)
        while len(live):
            steps.append((live, state[at[live]]))
            at[live] -= size[at[live]]
            live = live[at[live] >= off[live]]
        total = np.zeros(len(off) - 1, np.int64)
        for seg, _ in steps:
            total[seg] += 1
        base, out = np.cumsum(total), np.zeros(int(total.sum()), np.int64)
        for k, (seg, t) in enumerate(steps):
            out[base[seg] - 1 - k] = t
        return self._with_bytes(out, total)

    def _with_bytes(self, tokens, counts, spell=None):
        """Tokens behind the vocabulary replaced by the bytes of their character."""
        far = np.flatnonzero(tokens >= self.size)
        if not len(far):
            return tokens, counts
        spell = spell or (lambda t: self.text[t])
        parts = {t: self.byte_ids[list(spell(t).encode())] for t in np.unique(tokens[far]).tolist()}
        n = np.ones(len(tokens), np.int64)
        n[far] = [len(parts[t]) for t in tokens[far].tolist()]
        out = np.repeat(tokens, n)
        at = np.cumsum(n) - n
        for k, t in zip(at[far].tolist(), tokens[far].tolist()):
            out[k:k + len(parts[t])] = parts[t]
        row = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(row, n, minlength=len(counts)).astype(np.int64)

    def _learn(self, hashes, codes, off):
        """Remember the tokens of new distinct segments of code points."""
        if not len(hashes):
            return
        classes, size = self.classes[codes], np.diff(off)
        alone = classes[off[:-1]] == 0  # characters that no piece holds are segments of their own
        tokens, counts = np.zeros(0, np.int64), np.zeros(len(hashes), np.int64)
        known = np.flatnonzero(~alone)
        if len(known):
            keep = np.repeat(~alone, size)
            tokens, counts[known] = self._encode_segments(classes[keep].astype(np.int64),
                                                          np.concatenate(([0], np.cumsum(size[known]))))
        if alone.any():
            c = codes[off[:-1][alone]].astype(np.int64)
            more, n = self._with_bytes(c + self.size, np.ones(len(c), np.int64), lambda t: chr(t - self.size))
            counts[alone] = n
            hashes, counts = np.concatenate((hashes[known], hashes[alone])), np.concatenate((counts[known], counts[alone]))
            tokens = np.concatenate((tokens, more))
        at = np.cumsum(counts) - counts + len(self.tokens)
        all_hashes = np.concatenate((self.known, hashes))
        order = np.argsort(all_hashes)
        self.known = all_hashes[order]
        self.known_at = np.concatenate((self.known_at, at))[order]
        self.known_n = np.concatenate((self.known_n, counts))[order]
        self.tokens = np.concatenate((self.tokens, tokens.astype(np.int32)))

    def encode(self, buf: np.ndarray, offsets: np.ndarray):
        """Parts of a batch, in order: (i, j, tokens, counts) for its documents i to j."""
        if len(self.known) > REMEMBERED:
            self._forget()
        parts, found = [], {}
        for i, j in pieces(offsets, CHUNK):
            raw = buf[offsets[i]:offsets[j]]
            codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            at = chars[offsets[i:j + 1] - offsets[i]]
            codes = np.where(codes == 32, np.uint32(ord(SPACE)), codes)
            filled = np.diff(at) > 0
            codes = np.insert(codes, at[:-1][filled], ord(SPACE))  # a text starts with a space
            at = at + np.concatenate(([0], np.cumsum(filled)))
            classes = self.classes[codes]
            cut = np.ones(len(codes), bool)
            cut[1:] = ~self.joined[classes[:-1], classes[1:]]
            cut[at[:-1][filled]] = True
            start = np.flatnonzero(cut)
            end = np.append(start[1:], len(codes))[:len(start)]
            units = mix(codes.astype(np.uint64) + np.uint64(1))
            hashes = Sequence(units).ranges(start, end) if len(start) else np.zeros(0, np.uint64)
            doc = np.searchsorted(at, start, "right") - 1
            key, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            near = np.minimum(np.searchsorted(self.known, key), max(len(self.known) - 1, 0))
            new = np.flatnonzero(self.known[near] != key) if len(self.known) else np.arange(len(key))
            for k in new.tolist():
                h = int(key[k])
                if h not in found:
                    found[h] = codes[start[first[k]]:end[first[k]]]
            parts.append((i, j, key, inverse.astype(np.int32), np.bincount(doc, minlength=j - i)))
            if len(found) >= INDEXED:
                yield from self._parts(parts, found)
                parts, found = [], {}
        yield from self._parts(parts, found)

    def _parts(self, parts, found):
        """The tokens of cut documents, after their new segments are learned."""
        if found:
            self._learn(np.array(list(found), np.uint64), np.concatenate(list(found.values())),
                        np.concatenate(([0], np.cumsum([len(v) for v in found.values()]))))
        for i, j, key, inverse, segments in parts:
            at = np.searchsorted(self.known, key)
            n, base = self.known_n[at][inverse], self.known_at[at][inverse]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            tokens = self.tokens[np.arange(total) + np.repeat(base - (ends - n), n)] if total else np.zeros(0, np.int32)
            ends = np.concatenate(([0], ends))
            yield i, j, tokens, np.diff(ends[np.concatenate(([0], np.cumsum(segments)))])

    def decode(self, tokens: np.ndarray, counts: np.ndarray):
        """Bytes of the documents' texts, and their offsets: the tokens' bytes without the space
        that encoding put at the start."""
        n = self.token_at[tokens + 1] - self.token_at[tokens]
        ends = np.concatenate(([0], np.cumsum(n)))
        out = self.token_bytes[np.arange(ends[-1]) + np.repeat(self.token_at[tokens] - ends[:-1], n)]
        at = ends[np.concatenate(([0], np.cumsum(counts)))]
        lead = at[:-1][counts > 0]
        lead = lead[out[lead] == 32]
        keep = np.ones(len(out), bool)
        keep[lead] = False
        return out[keep], at - np.searchsorted(lead, at)


def _lists(counts, tokens):
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(tokens.astype(np.int32)))


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """One row per input row: ``key``, ids (the model's tokens of the whole text), n_tokens,
    round_trip (whether decoding the ids gives back the text).

    Rows stay in their partition: nothing is shuffled. Null or empty text: no tokens. Characters
    that the model doesn't know become its byte tokens. U+2581 in a text is the model's own sign
    for a space and decodes to one, so round_trip is false there. Very long texts are cut into
    segments chunk by chunk; a task holds one text and its tokens. Repeated rows and null keys are rows like others. Empty
    table: empty result. Extra columns are not read.
    """
    values = read_model(model or default_model(docs.sparkSession))
    docs = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(batches):
        encoder = Encoder(values)
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            for i, j, tokens, counts in encoder.encode(buf, off):
                back, at = encoder.decode(tokens, counts)
                source, source_at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                same = len(back) == len(source) and (at == source_at).all() and (back == source).all()
                ok = np.ones(j - i, bool)
                if not same:
                    back, source = back.tobytes(), source.tobytes()
                    ok[:] = [back[a:b] == source[c:d] for a, b, c, d in zip(
                        at[:-1].tolist(), at[1:].tolist(), source_at[:-1].tolist(), source_at[1:].tolist())]
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).slice(i, j - i), "ids": _lists(counts, tokens),
                    "n_tokens": pa.array(counts.astype(np.int64)), "round_trip": pa.array(ok)})

    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(run, f"id {kind}, ids array<int>, n_tokens long, round_trip boolean").withColumnRenamed("id", key)


def decode(rows: DataFrame, ids: str = "ids", text: str = "text", model: str | None = None) -> DataFrame:
    """``rows`` with column ``text``: the text of the tokens. Null ids: null text; ids beyond the
    vocabulary stop the job."""
    values = read_model(model or default_model(rows.sparkSession))
    schema = rows.drop(text).schema.add(text, "string")
    names = rows.drop(text).columns

    def run(batches):
        encoder = Encoder(values)
        for batch in batches:
            column = batch.column(names.index(ids))
            counts = np.array([0 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], np.int64)
            back, at = encoder.decode(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
            data = back.tobytes()
            out = [data[a:b].decode("utf-8", "replace") if ok else None
                   for a, b, ok in zip(at[:-1].tolist(), at[1:].tolist(), column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, text])

    return rows.drop(text).mapInArrow(run, schema)
