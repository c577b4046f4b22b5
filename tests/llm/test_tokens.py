import pyarrow as pa
from conftest_llm import TOKENIZER
from tokenizers import Tokenizer

from loanlake.llm.tokens import WordEncoder

PLAIN = Tokenizer.from_file(TOKENIZER)


def test_special_tokens_in_upper_case():
    texts = ["<|ENDOFTEXT|>", "x<|EndOfText|>", "A <|endoftext|> b", "END<|endoftext|>And <|StartOfText|>!", "a<|B c|>D <|"]
    ids, first = WordEncoder(TOKENIZER).encode(pa.array(texts))
    found = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert found[0] == [27, 347, 40786, 4160, 91, 285]


def test_units_of_marks_case_and_latin_letters():
    encoder = WordEncoder(TOKENIZER)
    texts = ["Été, été. ÉTÉ 1990, 1990", None, "", "1990." + "." * 40, "." * 40 + "été"]
    ids, first = encoder.encode(pa.array(texts))
    found = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [PLAIN.encode(t or "", add_special_tokens=False).ids for t in texts]
    kept = {unit.decode() for unit in encoder._units}
    assert kept == {"été", "1990", ",", ".", "." * 41, "." * 40 + "été"}


def test_letters_that_are_no_plain_units():
    texts = ["a×, ÷. ß! ÿ; ªº, µ́, J̌ É́ Å, İ KK ǰ. x y, ñ\u0085Ñ, d'ÉTÉ, L'S 's, ÀÞ×ß÷­."]
    texts += [t.upper() for t in texts] + ["Ð" * 300 + "," * 300, "ÀéÎõÜ" * 50 + " " + "<|" + "É,"]
    ids, first = WordEncoder(TOKENIZER, cached_words=3, cached_bases=2).encode(pa.array(texts))
    found = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
