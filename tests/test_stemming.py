import pytest
from pyspark.sql import functions as F

from tidemark.functions.stemming import stem, stemmed_terms

#: Words and stems that the algorithm's publication lists.
PAIRS = """boa boa boainain boainain boas boas bôas bôas boassu boassu boataria boat boate boat boates boat boatos boat bob bob boba bob bobagem bobag bobagens bobagens
bobalhões bobalhõ bobear bob bobeira bobeir bobinho bobinh bobinhos bobinh bobo bob bobs bobs boca boc bocadas boc bocadinho bocadinh bocado boc bocaiúva bocaiúv boçal boçal
bocarra bocarr bocas boc bode bod bodoque bodoqu body body boeing boeing boem boem boemia boem boêmio boêmi bogotá bogot boi boi bóia bói boiando boi quiabo quiab
quicaram quic quickly quickly quieto quiet quietos quiet quilate quilat quilates quilat quilinhos quilinh quilo quil quilombo quilomb quilométricas quilométr
quilométricos quilométr quilômetro quilômetr quilômetros quilômetr quilos quil química químic químicas químic químico químic químicos químic quimioterapia quimioterap
quimioterápicos quimioteráp quimono quimon quincas quinc quinhão quinhã quinhentos quinhent quinn quinn quino quin quinta quint quintal quintal quintana quintan
quintanilha quintanilh quintão quintã quintessência quintessent quintino quintin quinto quint quintos quint quintuplicou quintuplic quinze quinz quinzena quinzen
quiosque quiosqu""".split()


def test_published_pairs(spark):
    pairs = list(zip(PAIRS[::2], PAIRS[1::2], strict=True))
    found = {r.w: r.s for r in spark.createDataFrame([(w,) for w, _ in pairs], "w string").select("w", stem("w").alias("s")).collect()}
    assert {w: found[w] for w, _ in pairs} == dict(pairs)


@pytest.mark.parametrize("words", ["índice índices", "informação informações", "lógica lógicas", "felicidade felicidades", "ativo ativas", "falar falamos falavam falou"])
def test_forms_of_a_word_share_their_stem(spark, words):
    stems = {r.s for r in spark.createDataFrame([(w,) for w in words.split()], "w string").select(stem("w").alias("s")).collect()}
    assert len(stems) == 1


def test_stop_words_nulls_and_short_words(spark):
    df = spark.createDataFrame([("Os índices da base, e o índice",), (None,), ("",), ("x y",)], "t string")
    assert [r.s for r in df.select(stemmed_terms(F.col("t")).alias("s")).collect()] == [["índic", "bas", "índic"], None, [], ["x", "y"]]
    assert df.where("t IS NULL").select(stem("t").alias("s")).first().s is None
