from linkweave.llm import abuse


def test_common_words_start_no_phrase():
    """Of what a phrase needs, the rarest is looked for first: 'are', 'is', 'or' and the like stand in every text."""
    text = "these two are what the study is about, and all of this is for you or her; they go on with it until we pay"
    assert sum(len(ps) for _, ps in abuse._FIRST.iter(text)) <= 5


def test_letters_of_other_alphabets_are_still_read():
    assert abuse.find_terms("ѕuсh аn іdіоt") and abuse.find_terms("such an ídíót") and not abuse.find_terms("naïve café")
