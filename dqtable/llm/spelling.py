"""Spelling variants: words one letter apart, found by an index of grams of variable length.

Words are counted over all documents. Grams that many words hold form a dictionary of bounded size;
at each place of a word the walk from a gram of two letters goes on while the gram is in the
dictionary, so frequent grams become longer ones. Grams inside an earlier one are dropped. One edit
touches only grams that end in a stretch of places, which bounds per word how many it can affect:
two near words share at least one of the grams beyond that bound. So of each word that many of its
shortest lists, and one more, are merged with the index; what they meet is verified as a whole.

Rows: null texts have no words; a null doc_id is written as an empty text in the checksum. Repeated
rows count as often as they occur. Other columns are ignored. An empty table gives an empty result.
Words may be of any length. Of several near words that are equally frequent the first in code point
order is the form. The result does not depend on the order of rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dqtable.llm.common import fill, pieces, stored, work_folder

#: Runs of letters in texts whose A-Z are lower-cased already.
LETTERS = re.compile("[a-zÀ-ÿ]+")
#: Of the runs that a checksum picks, one in so many loses a letter.
DROP_ONE_IN = 199
#: Lengths of grams. The longest one of a pair of words is half of the shorter word at most: then
#: an edit leaves the first gram or the last one whole.
SHORTEST, LONGEST = 2, 6
#: A gram in more than one of so many words is in the dictionary. It holds at most this number times
#: the mean word length, per length of gram, whatever the number of words.
SHARE = 2000
#: Letters of a word that travels with its grams.
TRAVELS = 64
#: Different words (and their letters) that a task counts before it hands them on.
HELD_WORDS, HELD_LETTERS = 1 << 18, 1 << 24


def run_words(text: bytes, doc_id: str, counts: Counter) -> None:
    """Add the words of a text to `counts`, with the letters that checksums delete gone."""
    prefix = zlib.crc32(f"{doc_id}:".encode())
    for word, n in Counter(LETTERS.findall(text.lower().decode())).items():
        h = zlib.crc32(word.encode(), prefix)
        if h % DROP_ONE_IN == 0:
            gone = h % len(word)
            word = word[:gone] + word[gone + 1 :]
        counts[word] += n


def word_counts(docs: DataFrame, least_letters: int, least_count: int) -> DataFrame:
    """(word, n) over all documents. Tasks add up their own words before the shuffle."""
    names = ["word", "n"]

    def batch_of(counts: Counter) -> pa.RecordBatch:
        kept = {w: n for w, n in counts.items() if len(w) >= least_letters}
        words, n = pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())
        return pa.RecordBatch.from_arrays([words, n], names=names)

    def run(batches):
        counts: Counter = Counter()
        letters = 0
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                for doc_id, text in zip(part.column("id").to_pylist(), texts, strict=True):
                    run_words(text, doc_id, counts)
                    letters += len(text)
                    if len(counts) > HELD_WORDS or letters > HELD_LETTERS and len(counts) > 1:
                        letters = sum(map(len, counts))
                        if len(counts) > HELD_WORDS or letters > HELD_LETTERS:
                            yield batch_of(counts)
                            counts, letters = Counter(), 0
        yield batch_of(counts)

    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    texts = docs.select(doc_id.alias("id"), fill().alias("text"))
    found = texts.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def gram_dictionary(words: DataFrame, total: int, share: int) -> frozenset[str]:
    """Grams that more than one in `share` places of words hold, up to the longest but one.

    A gram occurs at most once per place, so of each length there are at most `share` times the
    mean word length: the set may go to the driver and to all tasks.
    """

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                counts.update(
                    word[p : p + q]
                    for q in range(SHORTEST, LONGEST)
                    for p in range(len(word) - q + 1)
                )
                if len(counts) > HELD_WORDS:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                        names=["gram", "n"],
                    )
                    counts = Counter()
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
            names=["gram", "n"],
        )

    counted = words.select("word").mapInArrow(run, "gram string, n long")
    frequent = counted.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > total / share)
    return frozenset(r.gram for r in frequent.select("gram").collect())


def grams_of(word: str, longest: int, dictionary: frozenset[str]) -> tuple[list[tuple[int, str]], int]:
    """(place, gram) of a word's grams, and the most of them that one edit can affect.

    A gram depends on its own letters, and on the grams before that might swallow it: an edit at
    place i affects it only if it ends in i .. i + longest - 1. An edit behind the word's end
    affects a gram that only the end of the word has cut short, one at most.
    """
    out: list[tuple[int, str]] = []
    end = 0
    for place in range(len(word) - SHORTEST + 1):
        stop = place + SHORTEST
        while stop < len(word) and stop - place < longest and word[place:stop] in dictionary:
            stop += 1
        if stop > end:
            out.append((place, word[place:stop]))
            end = stop
    ends = [p + len(g) - 1 for p, g in out]
    first = affected = 0
    for last, e in enumerate(ends):
        while e - ends[first] >= longest:
            first += 1
        affected = max(affected, last - first + 1)
    return out, affected


def _grams(words: DataFrame, dictionary: frozenset[str], least_letters: int) -> DataFrame:
    """(size, id, word, letters, probes, place, gram, needed): the grams of each word among words
    of `size` and of `size` + 1 letters.

    `probes`: whether the word has `size` letters and looks others up, `needed` lists then suffice.
    `letters` has a bit for each of the word's letters: two near words differ in two bits at most.
    Long words do not travel with each of their grams: `word` is null.
    """
    sent = words.sparkSession.sparkContext.broadcast(dictionary)
    fields = {
        "size": pa.int32(),
        "id": pa.int64(),
        "word": pa.string(),
        "letters": pa.int64(),
        "probes": pa.bool_(),
        "place": pa.int32(),
        "gram": pa.string(),
        "needed": pa.int32(),
    }

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), fields.values(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=list(fields))

    def run(batches):
        own = sent.value
        for batch in batches:
            rows: list[tuple] = []
            ids, texts = batch.column("id").to_pylist(), batch.column("word").to_pylist()
            for number, word in zip(ids, texts, strict=True):
                letters = sum(1 << bit for bit in {ord(c) % 63 for c in word})
                spelled = word if len(word) <= TRAVELS else None
                for size in (len(word), len(word) - 1):
                    if size < least_letters:
                        continue
                    found, affected = grams_of(word, min(LONGEST, size // 2), own)
                    word_of = (size, number, spelled, letters, size == len(word))
                    rows += [(*word_of, p, g, affected + 1) for p, g in found]
                if len(rows) >= 1 << 16:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    return words.select("id", "word").mapInArrow(
        run,
        "size int, id long, word string, letters long, probes boolean, place int, gram string, needed int",
    )


def near_pairs(
    words: DataFrame, folder: str, least_letters: int, share: int = SHARE
) -> DataFrame:
    """(a, b): the ids of every two words one edit apart, once; a is the shorter one or, of two of
    one length, that of the smaller id.

    `words` (id, word) is a stored table without repeats, of words of `least_letters` (four at
    least). A gram has the same place in both words if it lies before the edit; behind it, the place
    in a longer word is one more. So a list holds words of one size, or one letter more, by gram and
    place.
    """
    if least_letters < 2 * SHORTEST:
        raise ValueError(f"words need {2 * SHORTEST} letters at least")
    dictionary = gram_dictionary(words, words.count(), share)
    grams = stored(_grams(words, dictionary, least_letters), f"{folder}/grams")
    same, shifted = F.col("place"), F.col("place") - 1
    places = F.when(F.col("probes"), F.array(same)).otherwise(F.array(same, shifted))
    placed = grams.withColumn("place", F.explode(places)).where("place >= 0")
    lists = placed.select(_list().alias("list"), *_side("b"))
    lengths = lists.groupBy("list").agg(F.count("*").alias("entries"))
    # The shortest lists of a word, as many as are needed to meet every near word. Lists of a word
    # alone meet none; they come first, so they count among those needed.
    asked = grams.where("probes")
    own = Window.partitionBy("a")
    asked = asked.select(_list().alias("list"), *_side("a"), "needed", "place").join(lengths, "list")
    rank = F.row_number().over(own.orderBy("entries", "place"))
    asked = asked.withColumn("rank", rank).where("rank <= needed and entries > 1")
    probes = stored(asked.select("list", "a", "word_a", "of_a"), f"{folder}/probes")
    alike = F.bit_count(F.col("of_a").bitwiseXOR(F.col("of_b"))) <= 2
    ordered = F.col("longer_b") | (F.col("a") < F.col("b"))
    edits = F.levenshtein("word_a", "word_b", 1)
    met = probes.join(lists, "list").where(alike & ordered & F.coalesce(edits == 1, F.lit(True)))
    met = stored(met.select("a", "b", edits.isNull().alias("open")).distinct(), f"{folder}/met")
    # long words are compared where they met
    long_a = words.select(F.col("id").alias("a"), F.col("word").alias("word_a"))
    long_b = words.select(F.col("id").alias("b"), F.col("word").alias("word_b"))
    verified = met.where("open").join(long_a, "a").join(long_b, "b").where(edits == 1)
    return met.where("not open").unionByName(verified.select("a", "b", "open")).select("a", "b")


def _list() -> Column:
    """The list of a gram at a place, for words of a size. Lists that meet cost work only."""
    return F.xxhash64("size", "place", "gram")


def _side(name: str) -> list[Column]:
    """A word's columns as one side of a pair."""
    return [
        F.col("id").alias(name),
        F.col("word").alias(f"word_{name}"),
        F.col("letters").alias(f"of_{name}"),
        (~F.col("probes")).alias(f"longer_{name}"),
    ]


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """(id, root) from (id, form): forms are followed by pointer jumping.

    Each form is more frequent than its word by a factor, so there are no rings, chains are no
    longer than the logarithm of the largest count, and the rounds no more than the logarithm of
    that.
    """
    jumps = stored(forms.select("id", F.col("form").alias("root")), f"{folder}/roots-0")
    step = 0
    while True:
        step += 1
        on = jumps.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = jumps.join(on, "root", "left")
        if moved.where("next is not null").isEmpty():
            return jumps
        moved = moved.select("id", F.coalesce("next", "root").alias("root"))
        jumps = stored(moved, f"{folder}/roots-{step}")


def spelling_variants(
    docs: DataFrame, least_letters: int = 6, least_count: int = 5, ratio: int = 5
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the documents.

    `form`: the near word of largest count, if that is at least `ratio` times the word's own; `root`
    follows forms to the last. Words with many near ones are counted in the map tasks first.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word, or chains need not end")
    folder = work_folder(docs.sparkSession, "spelling")
    counts = word_counts(docs, least_letters, least_count)
    numbered = counts.select(F.monotonically_increasing_id().alias("id"), "word", "n")
    words = stored(numbered, f"{folder}/words")
    pairs = stored(near_pairs(words, folder, least_letters), f"{folder}/pairs")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    named = words.select(F.col("id").alias("b"), F.col("word").alias("form"), F.col("n").alias("m"))
    best = F.min(F.struct((-F.col("m")).alias("less"), "form", "b")).alias("best")
    near = both.join(named, "b").groupBy("a").agg(F.count("*").alias("n_near"), best)
    found = words.join(near.withColumnRenamed("a", "id"), "id", "left")
    enough = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    found = found.select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.b")).alias("form"),
        F.when(enough, F.col("best.form")).alias("form_word"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    found = stored(found, f"{folder}/found")
    roots = _roots(found.where("form is not null").select("id", "form"), folder)
    last = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("last")), "root")
    rooted = found.drop("form").join(last, "id", "left")
    return rooted.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("last", "word").alias("root"),
        "n",
        "n_near",
        "form_n",
    )
