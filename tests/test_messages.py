import pytest
from pyspark.sql import functions as F

from gleanery.functions.messages import message_tokens


def _tokens(spark, text, **kw):
    return spark.createDataFrame([(text,)], "t string").select(message_tokens(F.col("t"), **kw).alias("x")).first().x


CASES = [
    ("This is a cooool #dummysmiley: :-) :-P <3 and some arrows < > -> <--", {},
     "This is a cooool #dummysmiley : :-) :-P <3 and some arrows < > -> <--"),
    ("@remy: This is waaaaayyyy too much for you!!!!!!", {"strip_handles": True, "reduce_length": True},
     ": This is waaayyy too much for you ! ! !"),
    ("Don't mail a.b@c.org or call 123-456-7890 &amp; see http://x.org/a?b=1, OK", {},
     "Don't mail a.b@c.org or call 123-456-7890 & see http://x.org/a?b=1 , OK"),
    ("It cost 3.50, well-known :D LOUD", {"preserve_case": False}, "it cost 3.50 , well-known :D loud"),
    ("@user_1 says hi....", {}, "@user_1 says hi ..."),
    ("Price: &pound;100 &eacute;t&#233; &#x41;&#128; &nosuch;x &amp;lt; A&B", {}, "Price : £ 100 été A € x & lt ; A & B"),
    ("see example.com, sub.example.co.uk/ or foo.na@example.com", {}, "see example.com , sub.example.co.uk/ or foo.na@example.com"),
    ("\U0001F468\u200d\U0001F469\u200d\U0001F467 \U0001F44D\U0001F3FD \U0001F1E9\U0001F1EA\U0001F1EB\U0001F1F7", {},
     "\U0001F468\u200d\U0001F469\u200d\U0001F467 \U0001F44D\U0001F3FD \U0001F1E9\U0001F1EA \U0001F1EB\U0001F1F7"),
]


@pytest.mark.parametrize("text, options, expected", CASES)
def test_messages(spark, text, options, expected):
    assert _tokens(spark, text, **options) == expected.split(" ")


def test_empty_message(spark):
    assert _tokens(spark, None) == []
