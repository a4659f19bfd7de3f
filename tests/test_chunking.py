import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom.operators import chunking
from threadloom.operators.chunking import chunk_spans, split_text


def test_short_texts_are_one_chunk():
    assert split_text("") == []
    assert split_text("   \n ") == []
    assert split_text(" a b ") == ["a b"]
    assert split_text("w " * 249 + "w") == ["w " * 249 + "w"]


def test_sizes_around_the_limit():
    exact = "a" * 249 + " " + "b" * 250
    assert split_text(exact) == [exact]
    assert split_text(exact + " c") == [exact, "c"]


def test_overlap_repeats_whole_words():
    words = [f"{i:04d}" for i in range(300)]
    chunks = split_text(" ".join(words))
    assert chunks[0] == " ".join(words[:100])
    # Ten words of five characters with their space make the overlap of fifty.
    assert chunks[1] == " ".join(words[90:190])


def test_a_long_word_is_cut_between_characters():
    word = "".join(chr(ord("a") + i % 26) for i in range(600))
    chunks = split_text(f"x {word} y")
    # The piece is the word with its leading space; the cut repeats fifty characters.
    assert chunks == ["x", word[:499], word[449:], "y"]


def test_separators_are_tried_in_order():
    a, b, c = "a " * 200, "b " * 200, "c " * 200
    assert split_text(f"{a}\n\n{b}\n{c}") == [a.strip(), b.strip(), c.strip()]
    assert split_text("one\ntwo", 4, 0) == ["one", "two"]


texts = st.text(alphabet="ab \n\té", max_size=400)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(2, 40), st.integers(0, 10))
def test_chunks_cover_the_text_in_order(text, size, overlap):
    overlap = min(overlap, size - 1)
    spans = list(chunk_spans(text, 0, len(text), size, overlap))
    assert all(0 < b - a <= size for a, b in spans)
    covered = 0
    for a, b in spans:
        assert a <= covered and covered - a <= overlap and b > covered
        covered = b
    assert covered == len(text)
    if len(text) <= size and re.sub(r"\s", "", text):
        assert split_text(text, size, overlap) == [text.strip()]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=80), st.integers(15, 40))
def test_chunks_are_as_full_as_they_can_be(lengths, size):
    words = ["w" * n for n in lengths]
    text = " ".join(words)
    spans = list(chunk_spans(text, 0, len(text), size, 5))
    for a, b in spans[:-1]:
        following = text.find(" ", b + 1)
        assert (following if following >= 0 else len(text)) - a > size


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet="a \n", max_size=120), st.integers(2, 12), st.integers(0, 8))
def test_jumping_cuts_like_going_piece_by_piece(text, size, overlap):
    overlap = min(overlap, size - 1)
    for separator in " \n":
        args = (text, 0, len(text), size, overlap, separator)
        assert list(chunking._cut_by_jumps(*args)) == list(chunking._cut_by_pieces(*args))


def mart_rows(spark):
    schema = (
        "post_id string, post_title string, post_body string, post_author string, "
        "link_flair_text string, subreddit string, post_url string, comment_id string, "
        "comment_body string, comment_author string, comment_parent_id string, "
        "comment_permalink string"
    )
    post = ("p1", "Title", "word " * 200, "ann", None, "f", "u")
    return spark.createDataFrame(
        [
            (*post, "c1", "first", "bob", "t3_p1", "/c1"),
            (*post, "c2", "second " * 200, None, "t3_p1", "/c2"),
            (*post, "c3", "", "eve", "t3_p1", "/c3"),
            ("p2", "Other", "short", "cat", "flair", "g", "v", *[None] * 5),
        ],
        schema,
    ).withColumn("post_created_at", F.expr("timestamp_ntz'2024-01-01 10:00:00'"))


def test_posts_are_chunked_once(spark):
    rows = chunking.chunk_posts(mart_rows(spark)).orderBy("doc_id", "chunk_no").collect()
    texts = split_text("Title " + "word " * 200)
    assert [(r.doc_id, r.chunk_no, r.chunk_text) for r in rows] == [
        *[("p1", n, t) for n, t in enumerate(texts)],
        ("p2", 0, "Other short"),
    ]
    assert rows[0].metadata == {
        "POST_AUTHOR": "ann",
        "LINK_FLAIR_TEXT": None,
        "POST_ID": "p1",
        "SUBREDDIT": "f",
        "POST_URL": "u",
        "type": "post",
    }


def test_comments_are_not_split_and_empty_ones_left_out(spark):
    rows = chunking.chunk_comments(mart_rows(spark)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.chunk_text) for r in rows] == [("c1", "first"), ("c2", "second " * 200)]
    assert rows[0].metadata["COMMENT_PARENT_ID"] == "t3_p1"
    assert rows[1].metadata["type"] == "comment"


def test_chunk_ids_follow_the_text(spark):
    chunks = chunking.corpus(mart_rows(spark))
    ids = chunking.with_chunk_id(chunks)
    changed = chunking.with_chunk_id(chunks.withColumn("chunk_text", F.upper("chunk_text")))
    first = {r.chunk_id for r in ids.collect()}
    assert len(first) == chunks.count()
    assert not first & {r.chunk_id for r in changed.collect()}
