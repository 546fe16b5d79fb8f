"""The word encoders of packing and the Viterbi, held against the library and a plain search."""

import random
from itertools import combinations

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from stopwise.llm import queries
from stopwise.llm.packing import WordTokens, _step
from stopwise.llm.viterbi import MARK, Pieces

LETTERS = "aZé.,;:!?' \n\ṫsStTµªß×÷İ<|>1l日▁"
ODD = [
    "", " ", ".", "a. ", "it's. We're, x", "İ. K. Å, Å. ", "ﬁ. ß. º, σς. Σ.", "A" * 300 + ". " + "b" * 5000 + ", c",
    "<|endoftext|> a. <|startoftext|>b", "x<|endoftext|>y",
]


def texts(n, letters=LETTERS, size=40):
    chosen = random.Random(5)
    return ODD + ["".join(chosen.choice(letters) for _ in range(size)) for _ in range(n)]


def test_words_encode_as_the_library_does():
    path = public_tokenizers.path(queries.WORDS)
    library, own = Tokenizer.from_file(path), WordTokens(path)
    some = texts(3000)
    for text, ids in zip(some, own.encode(some), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def best_path(model, text):
    """Ids of the best-scoring path through the whole text, the longest last piece first among equals."""
    pieces = {model.id_to_piece(i): i for i in range(model.get_piece_size())}
    plain = {p: i for p, i in pieces.items() if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
    scores = {p: model.get_score(i) for p, i in plain.items()}
    longest, least = max(map(len, plain)), min(0.0, *scores.values()) - 10.0
    marked = MARK + text.replace(" ", MARK)
    best, back = [0.0], [(0, [])]
    for end in range(1, len(marked) + 1):
        choices = []
        for start in range(max(0, end - longest), end):
            piece = marked[start:end]
            if piece in plain:
                choices.append((best[start] + scores[piece], start, [plain[piece]]))
            elif end - start == 1:
                choices.append((best[start] + least, start, [pieces[f"<0x{b:02X}>"] for b in piece.encode()]))
        top = max(choices, key=lambda c: (c[0], -c[1]))
        best.append(top[0])
        back.append(top[1:])
    out, end = [], len(marked)
    while end:
        end, ids = back[end]
        out = ids + out
    return best[-1], out


def test_viterbi_equals_a_plain_search():
    path = public_tokenizers.path(queries.PIECES)
    model, own = sentencepiece.SentencePieceProcessor(model_file=path), Pieces(path)
    some = [t for t in texts(60, "aes.,t rino", 24) + texts(60, size=16) if t and len(t) < 400]
    for text, ids in zip(some, own.encode(some), strict=True):
        score, path_ids = best_path(model, text)
        if ids.tolist() != path_ids:  # equal sums may differ in their last bits when words are added up apart
            value = lambda x: sum(model.get_score(i) for i in x)
            assert np.isclose(value(ids.tolist()), value(path_ids)) and own.decode(ids) == own.decode(np.array(path_ids))
        assert own.decode(ids) == text.replace(MARK, " ")


def test_a_step_is_the_best_of_all_exchanges():
    """Donors of many pieces: every piece and every pair of them counts, not only the longest ones."""
    chosen, size = random.Random(9), 400
    for _ in range(60):
        bins = [{*range(k * 30, k * 30 + 30)} for k in range(4)]
        length = np.array([chosen.randint(1, 25) for _ in range(120)])
        owner = np.repeat(np.arange(4), 30)
        fill = np.array([length[list(b)].sum() for b in bins])
        size = int(fill.max()) + 6
        donor = int(np.argmin(fill))
        room = {b: size - int(fill[b]) for b in range(4) if b != donor}
        gives = [(x,) for x in bins[donor]] + list(combinations(bins[donor], 2))
        moves = [int(length[x]) for x in bins[donor] if length[x] <= max(room.values())]
        swaps = [
            gain for give in gives for b in room for y in bins[b] if 0 < (gain := int(length[list(give)].sum() - length[y])) <= room[b]
        ]
        give, take, to = _step(donor, bins, length, owner, fill, size)
        gain = int(length[list(give)].sum() - length[list(take)].sum())
        assert set(give) <= bins[donor] and set(take) <= bins[to] and gain <= room[to]
        assert gain == max(moves + swaps)
