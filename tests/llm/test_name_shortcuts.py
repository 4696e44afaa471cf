from linkweave.llm import names


def test_known_words_are_never_skipped_by_their_start():
    for word in names._TRADE_OF:
        if len(word) > 4:
            for i in range(len(word)):
                assert names.may_start(word[:i] + word[i + 1 :], names._STARTS) and names.may_start(word[:i] + "q" + word[i:], names._STARTS)
            assert names.two_trades(word + "services")
    assert not names.may_start("xqzrobur", names._TRADE_STARTS)
