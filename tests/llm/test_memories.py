"""What workers keep between tasks."""

import public_tokenizers

from moonstride.llm import bpe_automaton, census, language_codes, memories, token_blocks
from moonstride.llm.queries import TOKENIZER


def test_another_operator_forgets_what_a_worker_kept():
    for kept, path in ((bpe_automaton.codec, TOKENIZER), (token_blocks.piece_encoder, public_tokenizers.path("byte_bpe_50k.json"))):
        kept(path)
        memories.forget_others(kept.__module__)
        assert kept.cache_info().currsize == 1
        assert list(census.blocks_of(iter([]))) == []
        assert kept.cache_info().currsize == 0


def test_one_operator_at_a_time(llm, tricky):
    """The same worker serves tokens, languages and tokens again."""
    tokens = lambda: sorted(map(str, bpe_automaton.encode_and_decode(tricky, TOKENIZER).collect()))
    first = tokens()
    model = language_codes.fit(tricky)
    assert language_codes.identify(tricky, model).count() == tricky.count()
    assert tokens() == first
