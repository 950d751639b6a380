"""Cleaning, tokenising and measuring review text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The training cleaner removes all but a-z, A-Z and white space.
# The named class matches several times faster than the ranges written out.
NOT_LETTER = r"[^\p{Alpha}\s]"
# Every character that Python's str.split and \s take as white space.
WHITE = r"\p{IsWhite_Space}\x{1c}-\x{1f}"

# Stop words of the training stage (Spark ML's English list).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some such no nor not only
own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd
she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could
here's how's let's ought that's there's what's when's where's who's why's would
""".split()

# Stop words of the serving cleaner (the common English list of NLP toolkits).
SERVING_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having do does did doing a an the and but
if or because as until while of at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don don't should
should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
weren weren't won won't wouldn wouldn't
""".split()

# Run-together words that the serving tokeniser cuts in two.
SPLIT_WORDS = [("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na")]

# Length classes in characters, (upper bound, name).
LENGTH_BINS = [(50, "<50"), (100, "50-99"), (200, "100-199"), (500, "200-499"), (None, "500+")]


def clean_train(text: Column) -> Column:
    """Training cleaner: other characters become spaces; lower case; outer spaces go."""
    return F.trim(F.lower(F.regexp_replace(text, NOT_LETTER, " ")))


def ml_tokens(cleaned: Column) -> Column:
    """The tokens Spark ML's ``Tokenizer`` gives.

    A double space leaves an empty token; only those at the very end go.
    """
    return _spaced_words(F.translate(F.lower(cleaned), "\t\n\x0b\f\r", " " * 5), cleaned)


def train_tokens(text: Column) -> Column:
    """``ml_tokens(clean_train(text))`` in fewer passes over the text.

    The cleaner cuts what becomes a space at the start, but not a tab or a line end; all white space at the end goes.
    """
    inner = F.regexp_replace(text, r"^[^\p{Alpha}\t\n\x0B\f\r]+", "")
    return _spaced_words(F.lower(F.regexp_replace(inner, r"[^\p{Alpha}]", " ")), inner)


def _spaced_words(spaced: Column, before: Column) -> Column:
    """The words between single spaces; a text of white space only has none, an empty one an empty word."""
    words = F.rtrim(spaced)
    blank = (F.length(words) == 0) & (F.length(before) > 0)
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(words, " "))


def tokens(text: Column) -> Column:
    """Lower-case words without empty tokens."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != "")


def drop_stop_words(words: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Keep the other words, repeated ones included, in order."""
    return F.filter(words, lambda t: ~F.lower(t).isin(stop_words))


def serve_tokens(text: Column, stop_words: list[str] = SERVING_STOP_WORDS) -> Column:
    """Serving tokeniser: other characters vanish, so words around them run together."""
    letters = F.regexp_replace(F.lower(text), rf"[^\p{{Alpha}}{WHITE}]", "")
    joined = "|".join(rf"\b({a})({b})\b" for a, b in SPLIT_WORDS)
    firsts = "".join(f"${2 * i + 1}" for i in range(len(SPLIT_WORDS)))
    seconds = "".join(f"${2 * i + 2}" for i in range(len(SPLIT_WORDS)))
    words = F.split(F.regexp_replace(letters, joined, f"{firsts} {seconds}"), f"[{WHITE}]+")
    return F.filter(words, lambda t: (t != "") & ~t.isin(stop_words))


def clean_serve(text: Column, stop_words: list[str] = SERVING_STOP_WORDS) -> Column:
    """Serving cleaner without lemmas (see ``operators.lemma``); null becomes empty."""
    return F.coalesce(F.array_join(serve_tokens(text, stop_words), " "), F.lit(""))


def review_length(text: Column, null_words: int = 0) -> Column:
    """Words in the text; ``null_words`` is what a missing text counts as."""
    words = F.filter(F.split(text, f"[{WHITE}]+"), lambda t: t != "")
    return F.when(text.isNull(), null_words).otherwise(F.size(words))


def length_bin_no(text: Column) -> Column:
    """Number of the length class, 0 for the shortest."""
    chars = F.length(text)
    out = F.when(chars < LENGTH_BINS[0][0], 0)
    for no, (upper, _) in enumerate(LENGTH_BINS[1:], start=1):
        out = out.otherwise(no) if upper is None else out.when(chars < upper, no)
    return F.when(text.isNotNull(), out)


def length_bin(text: Column) -> Column:
    """Name of the length class."""
    return F.get(F.array(*[F.lit(name) for _, name in LENGTH_BINS]), length_bin_no(text))


def snippet(text: Column, chars: int = 100) -> Column:
    """The first characters, followed by dots."""
    return F.concat(F.substring(F.coalesce(text, F.lit("")), 1, chars), F.lit("..."))
