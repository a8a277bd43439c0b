import random
import re

import pytest

from tidemart.functions.names import camel, camel_columns
from tidemart.functions.text import keyword_rows, register_keyword_function, word_list

WORDS = ["移动", "联通", "移动联通", "电信", "手机", "双卡", "卡双", "待"]


def naive(text, words=()):
    text, found = text.lower(), []
    for run in re.findall("[a-z0-9]+", text):
        found.append(run)
        if re.search("[a-z]", run) and re.search("[0-9]", run):
            found += re.findall("[a-z]+|[0-9]+", run)
    for run in re.findall("[一-鿿]+", text) if words else ():
        covered = set()
        for start in range(len(run)):
            for word in words:
                if run.startswith(word, start):
                    found.append(word)
                    covered |= set(range(start, start + len(word)))
        found += [run[n] for n in range(len(run)) if n not in covered]
    return sorted(found)


def tokens(spark, texts, words=None):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    listed = None if words is None else word_list(spark, words)
    return sorted(r.keyword for r in keyword_rows(df, "t", words=listed).collect())


TITLE = "Apple iPhoneXSMax (A2104) 256GB 深空灰色 移动联通电信4G手机 双卡双待"


def test_title(spark):
    found = tokens(spark, [TITLE], WORDS)
    assert found == naive(TITLE, WORDS)
    assert {"a2104", "a", "2104", "移动联通", "联通", "深"} <= set(found) and "移" not in found


@pytest.mark.parametrize("seed", range(3))
def test_tokens_match_brute_force(spark, seed):
    draw = random.Random(seed)
    alphabet = "aB9 移动联通双卡待é-"
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(0, 60))) for _ in range(40)]
    texts += texts[:5]
    expected = sorted(sum((naive(t, WORDS) for t in texts), []))
    assert tokens(spark, texts, WORDS) == expected


def test_without_words_each_character_stands_alone(spark):
    assert tokens(spark, ["移动 4G", "", "---", "㐀か한"]) == sorted(["4", "4g", "g", "移", "动", "㐀", "か", "한"])


def test_sql_function_gives_the_same(spark):
    register_keyword_function(spark)
    spark.createDataFrame([(TITLE,), ("",), (None,)], "t string").createOrReplaceTempView("titles")
    rows = spark.sql("select k.keyword from titles, lateral keyword_tokens(t) k").collect()
    assert sorted(r.keyword for r in rows) == sorted(naive(TITLE) + re.findall("[一-鿿]", TITLE))


def test_camel_names(spark):
    assert camel("USER_first_NAME") == "userFirstName" and camel("id") == "id"
    assert camel_columns(spark.range(1).toDF("tm_id")).columns == ["tmId"]
