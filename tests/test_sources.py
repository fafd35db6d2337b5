import json

from affinia.operators import profile
from affinia.sources import readers, writers


def test_pairs_drop_repeated_headers_and_short_rows(spark, tmp_path):
    path = tmp_path / "pairs.csv"
    path.write_text("user,item\na,x,9\nuser,item\nb\nc,y\n")
    rows = readers.read_pairs(spark, str(path)).collect()
    assert sorted(map(tuple, rows)) == [("a", "x"), ("c", "y")]


def test_ratings_drop_rows_without_a_number(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text("user,item,stars\na,x,4.5\nb,y\nc,z,many\n")
    assert [tuple(r) for r in readers.read_ratings(spark, str(path)).collect()] == [("a", "x", 4.5)]


def test_empty_file(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("")
    assert readers.read_pairs(spark, str(path)).count() == 0


def reviews(spark, tmp_path):
    path = tmp_path / "reviews.json"
    rows = [
        {"user_id": "u", "business_id": "b", "useful": 1, "text": "a\U0001F600", "stars": 5.0},
        {"user_id": "u", "business_id": "c", "useful": 0, "text": "abc", "stars": 2.0},
        {"user_id": "v", "business_id": "b", "useful": 2, "text": "", "stars": 4.0},
    ]
    path.write_text("\n".join(map(json.dumps, rows)) + "\nnot json\n")
    return str(path)


def test_malformed_lines_are_counted(spark, tmp_path):
    counted = readers.count_malformed(spark, reviews(spark, tmp_path)).first()
    assert (counted["n_lines"], counted["n_malformed"]) == (4, 1)


def test_profile_sink(spark, tmp_path):
    rows = readers.read_reviews(spark, reviews(spark, tmp_path))
    out = tmp_path / "profile"
    for _ in range(2):
        writers.write_profile(rows, str(out))
    (line,) = [x for f in out.glob("part-*") for x in f.read_text().splitlines()]
    made = json.loads(line)
    assert made["n_review_useful"] == 2 and made["n_review_5_star"] == 1
    assert made["n_characters"] == 3 and made["n_user"] == 2 and made["n_business"] == 2
    assert made["top20_user"] == [{"id": "u", "n": 2}, {"id": "v", "n": 1}]


def test_state_means_and_sink(spark, tmp_path):
    rows = readers.read_reviews(spark, reviews(spark, tmp_path))
    path = tmp_path / "businesses.json"
    path.write_text('{"business_id": "b", "state": "NV"}\n{"business_id": "c", "state": "AZ"}\n')
    stars = profile.state_avg_stars(rows, readers.read_businesses(spark, str(path)))
    writers.write_state_stars(stars, str(tmp_path / "stars"))
    (text,) = [f.read_text() for f in (tmp_path / "stars").glob("part-*")]
    assert text.splitlines() == ["state,stars", "NV,4.5", "AZ,2.0"]


def test_other_sinks(spark, tmp_path):
    sets = spark.createDataFrame([(1, ["a"], 3)], "size int, items array<string>, freq long")
    writers.write_itemsets(sets, sets, str(tmp_path / "sets"))
    assert spark.read.json(str(tmp_path / "sets")).count() == 2
    pairs = spark.createDataFrame([("a", "b", 0.5)], "id_1 string, id_2 string, similarity double")
    writers.write_similar_pairs(pairs, str(tmp_path / "pairs"))
    back = spark.read.option("header", True).csv(str(tmp_path / "pairs"))
    assert back.columns == ["business_id_1", "business_id_2", "similarity"]
    edges = spark.createDataFrame([("a", "b", 1.0)], "u string, v string, betweenness double")
    writers.write_betweenness(edges, str(tmp_path / "edges"))
    nodes = spark.createDataFrame([("a", 1, "a")], "community_id string, size long, node string")
    writers.write_communities(nodes, str(tmp_path / "communities"))
    scores = spark.createDataFrame(
        [("u", "b", 1.0)], "user_id string, business_id string, prediction double"
    )
    writers.write_predictions(scores, str(tmp_path / "scores"))
    for name in ("edges", "scores"):
        assert spark.read.option("header", True).csv(str(tmp_path / name)).count() == 1
    assert spark.read.json(str(tmp_path / "communities")).count() == 1
