import pytest

from lamplight.operators.packed import split_packed

CASES = [
    ("names", "Matoto, Hama D.", ["Matoto, Hama D."]),
    ("names", "Rihazu, Siwa V. | Senmili & Dune Growers' Cooperative", ["Rihazu, Siwa V.", "Senmili & Dune Growers' Cooperative"]),
    ("names", "Vari D. Stoyabri, Ranti B. Yorasen, and Ganu N. Wapeva", ["Vari D. Stoyabri", "Ranti B. Yorasen", "Ganu N. Wapeva"]),
    ("names", "Zupol Gamiki, Stota Roturpe & Duma Tayaka", ["Zupol Gamiki", "Stota Roturpe", "Duma Tayaka"]),
    ("names", "College of Fisheries and Marine Studies, Titova", ["College of Fisheries and Marine Studies, Titova"]),
    ("names", "Bureau of Soils, Water and Forests of Madaltur;Ligrada, Haldal / Jundulo, Viri | Halsola, Gibo, Jr.;", ["Bureau of Soils, Water and Forests of Madaltur", "Ligrada, Haldal", "Jundulo, Viri", "Halsola, Gibo, Jr."]),
    ("names", "Lumbamo, Roha/Lowakel Seed/Fertilizer Board/Kelfal K. Badorpa", ["Lumbamo, Roha", "Lowakel Seed/Fertilizer Board", "Kelfal K. Badorpa"]),
    ("names", '["Halgiti, Halha", "Tokasen, Tikel"]', ["Halgiti, Halha", "Tokasen, Tikel"]),
    ("names", '"Baro Press; Price Division";;"Varama,  Dahal"', ["Baro Press; Price Division", "Varama, Dahal"]),
    ("names", 'Toha M. Ligrada\nFriends of the "Ranyomo" Reserve', ["Toha M. Ligrada", 'Friends of the "Ranyomo" Reserve']),
    ("names", '"Friends of the ""Ranyomo"" Reserve","Soma, Taro"', ['Friends of the "Ranyomo" Reserve', "Soma, Taro"]),
    ("names", "Gaverkel, Lika A., Jr.；Gikortur, Tima", ["Gaverkel, Lika A., Jr.", "Gikortur, Tima"]),
    ("terms", '"Maize, commercial" , Taro dormancy , humidity/lime ratio', ["Maize, commercial", "Taro dormancy", "humidity/lime ratio"]),
    ("terms", "1. Sparse mulch 2. Sesame, initial 3. Duck -- Rootstock", ["Sparse mulch", "Sesame, initial", "Duck -- Rootstock"]),
    ("terms", "(1) ripening and digestion; (2) humidity and trait;", ["ripening and digestion", "humidity and trait"]),
    ("terms", "•Partial herbicide• Mussel, dwarf", ["Partial herbicide", "Mussel, dwarf"]),
    ("terms", "Cacao -- Humidity\r\nLate  wind\r\n\r\nyam/rice balance", ["Cacao -- Humidity", "Late wind", "yam/rice balance"]),
    ("terms", "wage and runoff,soil-borne acacia", ["wage and runoff", "soil-borne acacia"]),
    *[("terms", x, []) for x in (None, "", " ", "[]", "N/A", "null", "Not stated", '"Unknown"', ";;")],
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, c if k == "names" else None, c if k == "terms" else None, "x") for i, (k, c, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id long, authors string, subjects string, field string")
    out = {}
    for r in split_packed(df, "id", {"authors": "names", "subjects": "terms"}).orderBy("id", "pos").collect():
        out.setdefault(r.id, []).append((r.pos, r.item))
    return out


@pytest.mark.parametrize("i", range(len(CASES)))
def test_cells(found, i):
    assert found.get(i, []) == list(enumerate(CASES[i][2], 1))


def test_edges(spark):
    schema = "id long, authors string"
    assert split_packed(spark.createDataFrame([], schema), "id", {"authors": "names"}).count() == 0
    long = "; ".join(f"Surname{i}, Given" for i in range(5000))
    twice = spark.createDataFrame([(1, long), (1, long)], schema)
    assert split_packed(twice, "id", {"authors": "names"}).count() == 10000


def skeleton(spark, kind, cell):
    from pyspark.sql import functions as F

    from lamplight.operators import packed as P

    df = spark.createDataFrame([(kind, cell)], "kind string, cell string")
    shapes = F.array_join(F.transform(F.regexp_extract_all("cell", F.lit(P.UNITS), F.lit(0)), P._shape), "")
    return df.select(F.array_join(F.transform(P._runs(shapes, F.col("kind")), lambda r: P._masked(r, F.col("kind"))), "")).first()[0]


def test_skeletons_tell_delimiters_and_not_words(spark):
    alike = [("terms", "rice growth; soil", "Duck, wild ;Cacao -- Humidity of the north/south ratio"), ("names", "Baro, Taro; Soma Press", "Office of Soils, Water and Forests of Siga ; Varama, Dahal A."), ("terms", '"rice, wild", soil', '"Maize, commercial" , Taro dormancy of lime/soil')]
    for kind, a, b in alike:
        assert skeleton(spark, kind, a) == skeleton(spark, kind, b)
    apart = [("terms", "a; b", "a, b"), ("terms", "rice/soil", "rice / soil"), ("names", "Toha Lima, Baro Soma", "Lima, Toha"), ("terms", '"a; b", c', '"a"; b, c')]
    for kind, a, b in apart:
        assert skeleton(spark, kind, a) != skeleton(spark, kind, b)
