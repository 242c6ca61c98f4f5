import re

from pyspark.sql import functions as F

from switchflow.llm import pii
from tests.llm.cases import ODD, documents, empty

ROWS = [
    (1, "Mail jo.doe+x@mail3.example.com or JO.DOE+X@MAIL3.EXAMPLE.COM, call +1 (938) 555-1226 or 938-555-1226."),
    (2, "Again jo.doe+x@mail3.example.com, and +1 938 555 1226; card 4111 1111 1111 1111 or 4111111111111111, ip 10.1.2.3, 8.8.8.8."),
    (3, "Mr. John Smith met Mrs Smith and Ms. Anna Jones. Herr Müller, Frau MÜLLER-LÜDENSCHEIDT. Г-н Иванов, г-жа Анна Иванова."),
    (4, "ssn 123-45-6789. Not: 1234-5678, 1.2.3, 2.0., 300.1.1.1, v1.2.3.4.5, 12345678901234567, a@b"),
    (5, None), (5, None), (6, ""), (None, "x@y.org"), (None, "x@y.org"), (7, "x@y.org" * 1), (7, "other text, same id, z@y.org"),
]


def run(spark, rows=ROWS, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_email", F.lit("clash")).withColumn("new", F.lit(1)).withColumn("pos", F.lit(2))
    return pii.replace_pii(docs, **more).collect()


def test_surrogates_keep_type_format_and_identity(spark):
    got = run(spark)
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    one, two, three, four = (by[i][0].text for i in (1, 2, 3, 4))
    mail = re.search(r"Mail (\S+@\S+) or (\S+),", one)
    assert mail[1] != "jo.doe+x@mail3.example.com" and mail[2] == mail[1].upper() and re.fullmatch(r"[a-z]{2}\.[a-z]{3}\+[a-z]@[a-z]{4}\d\.[a-z]{7}\.com", mail[1])
    assert f"Again {mail[1]}," in two
    phone = re.search(r"call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4})\.$", one)
    assert f"+1 {phone[1]} {phone[2]} {phone[3]};" in two and phone.groups()[:3] != ("938", "555", "1226")
    card = re.search(r"card ((?:\d{4} ){3}\d{4}) or (\d{16}),", two)
    assert card[1].replace(" ", "") == card[2] != "4111111111111111" and card[2][0] == "4"
    digits = [int(c) for c in card[2][::-1]]
    assert (sum(digits[::2]) + sum(2 * d - 9 * (d > 4) for d in digits[1::2])) % 10 == 0
    assert re.search(r"ip 10\.\d+\.\d+\.\d+, \d+\.\d+\.\d+\.\d+\.$", two) and "8.8.8.8" not in two and "10.1.2.3" not in two
    name = re.match(r"Mr\. (\w+) (\w+) met Mrs (\w+) and Ms\. (\w+) (\w+)\. Herr (\w+), Frau (\w+)\. Г-н (\w+), г-жа (\w+) (\w+)\.$", three.replace("г-н", "Г-н"))
    assert name is not None and name[2] == name[3] and "Smith" not in three and name[4].endswith("ina") and name[1].endswith("en")
    assert name[7].isupper() and name[9].endswith("ина") or "Г-н Иванов" in three
    assert re.match(r"ssn \d{3}-\d{2}-\d{4}\. ", four) and "123-45-6789" not in four
    assert four.endswith("Not: 1234-5678, 1.2.3, 2.0., 300.1.1.1, v1.2.3.4.5, 12345678901234567, a@b")
    assert [r.text for r in by[5]] == [None, None] and by[6][0].text == ""
    assert len({r.text for r in by[None]} | {r.text for r in by[7]}) == 2 and all("@" in r.text and "y.org" not in r.text for r in by[None])
    assert (by[1][0].n_email, by[1][0].n_phone, by[2][0].n_card, by[2][0].n_ip, by[4][0].n_ssn) == (2, 2, 2, 2, 1)


def test_keys_change_surrogates(spark):
    a, b = ({r.doc_id: r.text for r in run(spark, ROWS[:2], key=k)} for k in ("k1", "k2"))
    assert a[1] != b[1] and a == {r.doc_id: r.text for r in run(spark, ROWS[:2], key="k1")}


def test_distinct_entities_stay_distinct(spark):
    # 1,000 three-digit endings in a space of few numbers, and short addresses: both must draw again.
    entities = [("email", f"{a}{b}@x.org") for a in "abcdefghij" for b in "abcdefghij"] + [("ip", f"10.0.{a}.{b}") for a in range(20) for b in range(20)]
    df = pii.assign(spark.createDataFrame(entities, "type string, norm string"), "k")
    rows = df.collect()
    assert len({(r.type, r.canonical) for r in rows}) == len(entities) == len(rows)
    assert not {(r.type, r.canonical) for r in rows} & set(entities)


def test_names_are_replaced_where_a_text_repeats_them(spark):
    rows = [
        (1, "Mr John Smith came. Smith said that John, not Smithson or Mc-Smith, wrote to Smith's friend smith."),
        (2, "No title here: Smith and John stay."),
        (3, "Dr Anna-Lena Weiß and Prof. Weiß: Anna-Lena, Anna, WEISS, Weiß."),
        (4, "Mrs May left in May; O'Neill? Mr O'Neill! O'Neill."),
    ]
    got = {r.doc_id: r.text for r in run(spark, rows)}
    m = re.fullmatch(r"Mr (\w+) (\w+) came\. (\w+) said that (\w+), not Smithson or Mc-Smith, wrote to (\w+)'s friend smith\.", got[1])
    assert m and m[2] == m[3] == m[5] != "Smith" and m[1] == m[4] != "John"
    assert got[2] == rows[1][1]
    m = re.fullmatch(r"Dr (\w+) (\w+) and Prof\. (\w+): (\w+), Anna, WEISS, (\w+)\.", got[3])
    assert m and m[2] == m[3] == m[5] and m[1] == m[4] and not m[1].endswith("ina")
    m = re.fullmatch(r"Mrs (\w+) left in (\w+); (\w+)\? Mr (\w+)! (\w+)\.", got[4])
    assert m and m[1] == m[2] and m[3] == m[4] == m[5]


def test_full_spaces_end_in_an_exchange(spark):
    # Every address of 192.168.0.0/16, most of the numbers of five digits behind a plus sign, and one that is alone.
    ips = spark.range(65536).selectExpr("'ip' AS type", "concat('192.168.', id div 256, '.', id % 256) AS norm")
    phones = spark.range(95000).selectExpr("'phone' AS type", "lpad(id, 5, '0') AS norm")
    entities = ips.union(phones)
    got = pii.assign(entities, "k", rounds=6)
    assert got.count() == 160536 and got.select("type", "canonical").distinct().count() == 160536
    assert got.filter("norm = canonical").count() == 0
    ip = got.filter("type = 'ip'")
    assert ip.join(ips.select(F.col("norm").alias("canonical")), "canonical", "left_semi").count() == 0
    assert ip.filter("canonical LIKE '10.%' OR canonical LIKE '192.168.%'").count() >= 65535  # one alone after the last draw has zeros
    assert got.filter("type = 'phone' AND length(canonical) <> 5").count() == 0
    alone = pii._exchanged(spark.createDataFrame([("ssn", "123-45"), ("card", "9")], "type string, norm string"), "k")
    assert {r.norm: r.canonical for r in alone.collect()} == {"123-45": "000-00", "9": "0"}


def test_other_texts_pass_untouched(spark):
    docs = documents(spark, ODD).withColumn("n_words", F.lit(1))
    got = pii.replace_pii(docs, counts=False)
    assert got.columns == docs.columns
    order = lambda r: str(r)
    assert sorted(got.collect(), key=order) == sorted(docs.collect(), key=order)
    assert pii.replace_pii(empty(spark)).count() == 0


def test_no_planted_data_is_left(spark, sf):
    import duckdb

    find = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|(?<![\w.])\d{16}(?!\w)|(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)")
    old = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    found = 0
    for r in pii.replace_pii(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")).collect():
        mentions = find.findall(old[r.doc_id])
        found += len(mentions)
        assert not any(m in r.text for m in mentions)
        assert len(find.split(old[r.doc_id])) > 1 or r.text == old[r.doc_id]
    assert found > 0
