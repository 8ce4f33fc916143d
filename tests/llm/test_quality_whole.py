"""Statistics read whole texts and whole words."""

import numpy as np

from terrier.llm import quality

RUSSIAN = "Вчера вечером мы долго гуляли по старому городу и говорили о книгах, которые читали в детстве. Погода была тёплая, на улицах было мало людей, и только у реки играла тихая музыка. Потом мы зашли в маленькое кафе, заказали чай с лимоном и сидели там почти до полуночи."
POLISH = "Wczoraj wieczorem długo spacerowaliśmy po starym mieście i rozmawialiśmy o książkach, które czytaliśmy w dzieciństwie. Pogoda była ciepła, na ulicach było mało ludzi, a nad rzeką grała cicha muzyka. Potem weszliśmy do małej kawiarni, zamówiliśmy herbatę z cytryną i siedzieliśmy tam prawie do północy."
TURKISH = "Dün akşam eski şehirde uzun uzun yürüdük ve çocukluğumuzda okuduğumuz kitaplar hakkında konuştuk. Hava sıcaktı, sokaklarda az insan vardı ve nehir kıyısında sessiz bir müzik çalıyordu. Sonra küçük bir kahveye girdik, limonlu çay söyledik ve neredeyse gece yarısına kadar oturduk."


def _distinct(words):
    return next(quality.Reader().read([" ".join(words)]))[0][6 - 1]


def test_the_last_words_of_a_text_count():
    varied = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(64)]
    assert _distinct(varied) == 1
    loop = _distinct(varied + ["buy", "now"] * 31 + ["buy"])
    # Of 127 words, 64 stand in a window of distinct ones, 63 in one of three.
    assert np.isclose(loop, (64 + 63 * 3 / 64) / 127)
    assert np.isclose(_distinct(varied + varied[:1]), 1)


def test_the_whole_outline_is_hashed():
    start = "a1" * 40
    assert quality.shape(start + "#") != quality.shape(start + "!")
    first, second = (next(quality.Reader().read([start + end]))[1] for end in ("#x", "!x"))
    assert first[0] != second[0]


def test_clean_text_of_another_language_has_no_fault_and_survives(spark):
    texts = [RUSSIAN, POLISH, TURKISH]
    for stats, *_ in quality.Reader().read(texts):
        assert "b" not in quality.vote(stats)
    model = quality.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert quality.keep_good(docs, model).count() == 3
    stats = next(quality.Reader().read([" ".join(["zxcv qwrt plkj mnbv"] * 10)]))[0]
    assert quality.vote(stats)[quality.LABELLERS.index("function words")] == "b"
