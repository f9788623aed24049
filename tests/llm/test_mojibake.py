import random

import pytest

from examloom.llm import mojibake
from examloom.session import table

CHAINS = [("utf_8", "cp1252"), ("utf_8", "latin_1"), ("utf_8", "mac_roman"), ("utf_8", "cp437"), ("utf_8", "cp1251"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437")]


@pytest.fixture(scope="module")
def model(spark):
    return mojibake.train(table(spark, "/root/testdata/sf0.1", "get_headers"))


def test_round_trips(model):
    """Clean texts stay; garbled ones come back."""
    clean = ["Die Prüfer fanden keine wesentlichen Mängel bei der Bewertung.", "La gerencia deberá presentar un informe según el auditor.", "The café lease (Östervåld) was ended.", "The bank’s “à la carte” fees – see § 12 – rose."]
    for text in clean:
        assert model.restore(text) == (False, text)
        for right, page in CHAINS:
            raw = text.encode(right)
            try:
                seen = raw.decode(page)
            except UnicodeDecodeError:
                seen = "".join(bytes([b]).decode(page, "replace").replace("�", chr(b)) for b in raw)
            garbled, fixed = model.restore(seen)
            assert garbled, (right, page, seen)
            if right == "utf_8":
                assert fixed == text, (right, page)
        twice = text.encode().decode("latin_1").encode().decode("latin_1")
        assert model.restore(twice) == (True, text)


def test_part_of_a_text(model):
    text = "Déjà-vu findings. " + "Die Prüfer fanden".encode().decode("latin_1")
    assert model.restore(text) == (True, "Déjà-vu findings. Die Prüfer fanden")


def test_hyphens_and_symbols_stay(model):
    for text in ["increase in pri¬\nvate loans", "inade\xad\nquate", "Tiers ¼, ½ and ¾", "SÃO BRENTÓVIO and ÂNCORA DO SUL"]:
        assert model.restore(text) == (False, text)


def test_table(spark, model):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "plain", 1), (4, "cafÃ©", 1), (4, "cafÃ©", 1), (5, "lost � char", 1), (None, "é" * 100_000, 1)], "topic_id long, topic_text string, garbled int")
    rows = {r.topic_id: (r.garbled, r.restored) for r in mojibake.repair(df, model=model).collect()}
    assert rows[1] == (False, None) and rows[2] == (False, "") and rows[3] == (False, "plain") and rows[4] == (True, "café") and rows[5] == (True, "lost � char")
    assert mojibake.repair(df.limit(0)).count() == 0
