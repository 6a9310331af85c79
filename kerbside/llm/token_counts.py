"""Token counts by dynamic programming over a trie (operator 7).

A unigram model scores a pre-token's segmentations by the sum of its pieces'
log probabilities. The best score of a prefix does not depend on what follows,
so new distinct pre-tokens are put into a trie and each node's forward score
is computed once, from the nodes on its branch; the terminal node holds the
number of tokens of the best segmentation. The trie is walked in sorted order,
which visits it depth first: only the current branch is held, and two words
share the scores of their common prefix.

Pre-tokens are the words between ASCII white space with the piece alphabet's
word mark before them. The pieces come from a public vocabulary file; where
that has no probabilities (a BPE file has ranks), piece ``r`` gets the
Zipf-Mandelbrot probability 1 / (r + 2.7), normalised. A character without a
piece costs ``UNKNOWN_PENALTY`` more than the worst piece and counts one token
per UTF-8 byte (byte fallback). Ties go to fewer tokens.

Cases: NULL, empty and blank texts have no tokens; repeated rows each give a
row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import as_bytes, slices, text_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Terminal counts kept per worker; they only save time.
MAX_CACHED = 400_000


def zipf_pieces(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with log probabilities by rank; control,
    unknown and byte pieces left out. The file bounds the size."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    total = math.log(sum(1 / (r + 2.7) for r in range(1, len(plain) + 1)))
    return {sp.id_to_piece(i): -math.log(r + 2.7) - total for r, i in enumerate(plain, 1)}


class Counter:
    """Terminal counts of pre-tokens under one set of pieces."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.counts: dict[bytes, int] = {}

    def learn(self, words: list[bytes]) -> None:
        """Put new words into the trie and store their terminal counts."""
        pieces, longest = self.pieces.get, self.longest
        branch = ""
        scores, tokens = [0.0], [0]
        for text, word in sorted((MARK + text_of(w), w) for w in words):
            shared, n = 0, min(len(branch), len(text))
            while shared < n and branch[shared] == text[shared]:
                shared += 1
            del scores[shared + 1:], tokens[shared + 1:]
            for end in range(shared + 1, len(text) + 1):
                best, count = scores[end - 1] + self.unknown, tokens[end - 1] + len(text[end - 1].encode())
                for start in range(end - longest if end > longest else 0, end):
                    score = pieces(text[start:end])
                    if score is not None:
                        score += scores[start]
                        if score > best or score == best and tokens[start] + 1 < count:
                            best, count = score, tokens[start] + 1
                scores.append(best)
                tokens.append(count)
            branch = text
            self.counts[word] = tokens[-1]

    def count(self, texts: list[bytes | None]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each whole text."""
        split = [(t or b"").split() for t in texts]
        new = set().union(*split) if split else set()
        if len(self.counts) + len(new) > MAX_CACHED:
            self.counts = {w: self.counts[w] for w in new & self.counts.keys()}
        self.learn([w for w in new if w not in self.counts])
        return [(len(words), sum(map(self.counts.__getitem__, words))) for words in split]


def _worker_counter(shared) -> Counter:
    if "counter" not in shared.value:
        shared.value["counter"] = Counter(shared.value["pieces"])
    return shared.value["counter"]


def count_tokens(df: DataFrame, pieces: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_pretokens`` and ``n_tokens`` of the whole text. A
    narrow pass; the pieces (bounded by their file) are broadcast."""
    shared = df.sparkSession.sparkContext.broadcast({"pieces": pieces})

    def run(batches):
        counter = _worker_counter(shared)
        for part in slices(batches, 1):
            n = counter.count(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([a for a, _ in n], pa.int64()), pa.array([b for _, b in n], pa.int64())],
                                             names=["row", "n_pretokens", "n_tokens"])

    id_type = df.select(F.col(id_col).alias("i")).schema["i"].dataType.simpleString()
    out = (df.select(F.col(id_col).alias("row"), as_bytes(text_col).alias("raw"))
           .mapInArrow(run, f"row {id_type}, n_pretokens long, n_tokens long"))
    return out.select(F.col("row").alias(id_col), "n_pretokens", "n_tokens")
