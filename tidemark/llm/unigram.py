"""Token counts of a unigram vocabulary: forward scores over a trie of distinct pre-tokens."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import Seen, map_batches, table, texts

PIECES = "piece_bpe_32k.model"
SPACE = "▁"
#: Log probability of a piece by its rank r: -log(r + OFFSET). A byte of a character without a piece is one token.
OFFSET, BYTE_SCORE = 10.0, -30.0
MOST_MODEL_BYTES = 64 << 20


@lru_cache(maxsize=2)
def pieces_of(blob: bytes) -> dict[str, float]:
    """Log probabilities of a sentencepiece model's ordinary pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=blob)
    ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return {model.id_to_piece(i): -float(np.log(r + OFFSET)) for r, i in enumerate(ids)}


def terminal_counts(words: list[str], pieces: dict[str, float], longest: int) -> list[int]:
    """Tokens of each word's best segmentation (the highest score, then the fewest tokens).

    The words' trie is walked depth first, which is their sorted order: `score` and `count` hold the path from the root to
    the current node, so a prefix that words share is computed once and only the path is in memory.
    """
    out = [0] * len(words)
    score, count, path = [0.0], [0], ""
    for k in sorted(range(len(words)), key=words.__getitem__):
        word, shared, most = words[k], 0, min(len(path), len(words[k]))
        while shared < most and path[shared] == word[shared]:
            shared += 1
        del score[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            n_bytes = len(word[end - 1].encode())
            best, tokens = score[end - 1] + BYTE_SCORE * n_bytes, count[end - 1] + n_bytes
            for start in range(max(0, end - longest), end):
                if (p := pieces.get(word[start:end])) is not None:
                    s, c = score[start] + p, count[start] + 1
                    if s > best or s == best and c < tokens:
                        best, tokens = s, c
            score.append(best)
            count.append(tokens)
        path = word
        out[k] = count[-1]
    return out


def token_counts(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, n_pretokens. A pre-token is a word between white space with the mark of
    a word's start before it. Null, empty and blank texts have none; repeated rows give repeated results; other columns are
    ignored. No shuffle: a task keeps the counts of pre-tokens it has met, up to a bound, and walks the trie of new ones."""
    blob = Path(model_path or public_tokenizers.path(PIECES)).read_bytes()
    if len(blob) > MOST_MODEL_BYTES:
        raise ValueError("the piece model is too large to send to every task")
    sent = docs.sparkSession.sparkContext.broadcast(blob)

    def make():
        pieces = pieces_of(sent.value)
        longest, seen = max(map(len, pieces)), Seen()

        def step(cols):
            split = [t.split() if t else [] for t in cols["text"]]
            new = seen.missing(w for ws in split for w in ws)
            seen.update(zip(new, terminal_counts([SPACE + w for w in new], pieces, longest), strict=True))
            yield {"doc_id": cols["doc_id"], "n_tokens": [sum(map(seen.__getitem__, ws)) for ws in split], "n_pretokens": list(map(len, split))}

        return step

    return map_batches(texts(docs, id_col, text_col), make, "doc_id long, n_tokens long, n_pretokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the best path. The pieces' scores are nominal: the log probability of their rank."""
    return token_counts(table(spark, sf_dir, "documents"))
