"""Problem 3: hearing transcripts into clean, ordered speaker turns.

All of it is SQL: expressions find and remove time marks, hesitations and notes of noises; a text that runs on into other
labelled speakers is cut at the labels; windows put turns in page order and carry the last speaker forward; consecutive
turns of one speaker become one by a gaps-and-islands number.

Nulls: a null turn text is an empty one; a null speaker is an empty one; a turn before any speaker keeps an empty speaker.
A null turns array or an empty one gives no row. Null pages take the last page before them. Repeated rows stay apart by
their id. A turn left without words is dropped from the clean turns, never from ``dirt``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The forms that marks take in the transcripts.
TIME = (
    r"[\[(<{]\s*\d{1,2}[:.]\d{2}(?:[:.]\d{2})?(?:[.,]\d{1,3})?\s*(?:[ap]\.?m\.?)?\s*[\])>}]"
    r"|[\[(<{]\s*\d+(?:\.\d+)?\s?s\s*[\])>}]"
    r"|(?<![\d:])\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?![\d:])(?:\s*-(?=\s))?"
    r"|^\s*\d{1,2}:\d{2}(?=\s+(?:-\s+)?\p{Lu})"
)
HESITATIONS = "uh-huh|uhh?|umm?|erm|hmm?|mm|mhm|ah|eh|er|ähm?|öhm?|öh|bah euh|euh|heu|hum"
_WORDS = r"(?:der|die|das|und|von|den|dem|auf|im|wurde|nicht)"
NOISES = (
    "laugh|applau|cough|sigh|sneez|weep|sob|cries|crying|whisper|commotion|uproar|murmur|pause|silence|music|noise|inaudible"
    "|unintelligible|indiscernible|crosstalk|cross-talk|overlapping|gavel|buzz|static|feedback|door|slam|knock|microphone|mic "
    "|bell|ringing|rustl|footsteps|gallery|bench|disturbance|interruption|gelächter|beifall|husten|unruhe|rires|applaudissements|toux|bruit"
)
SOUND = (
    rf"(?i:\(\(\s*[^()]*(?:{NOISES})[^()]*\)\)|\([^()]*(?:{NOISES})[^()]*\)|\[[^\[\]]*(?:{NOISES})[^\[\]]*\])"
    r"|\*[a-z][a-z ]{2,30}\*|<[a-z][a-z ]{2,30}>|\{[a-z][a-z ]{2,30}\}"
)
_TITLE = r"(?:(?i:mr|mrs|miss|madame|mme|dr|prof|professor|col|colonel|gen|general|maj|major|capt|captain|judge|sir)\b\.?)"
_OFFICE = r"(?:(?i:(?:the )?(?:presiding )?(?:president|marshal|marshall|interpreter|interpretor|registrar|stenographer|clerk|secretary)|pres\.))"
_NOTE = r"(?:\s*[\[(][^\[\]()]{1,30}[\])])?"
_LEAD = r"(?:>>\s*|[\[*]|Q\.\s+|SPEAKER \d+:\s*|[\[(]?\d{1,2}:\d{2}[\])]?\s+)*"
_CAPS = r"(?=[^a-z]{0,60}?\p{Lu}{3})[\p{Lu}0-9][\p{Lu}0-9.'’-]*(?:[ ,.]{1,2}[\p{Lu}0-9][\p{Lu}0-9.'’-]*){0,7}"
_MIXED = r"\p{Lu}[\p{L}0-9.'’-]+(?:[ ,]{1,2}(?:of |the )*\p{Lu}[\p{L}0-9.'’-]*){1,7}"
_TITLED = rf"{_TITLE}\s*(?:\p{{Lu}}[\p{{L}}0-9.'’-]*[ ,]{{0,2}}){{1,4}}"
_END = r"[\]*]?"
LABEL = (
    rf"{_LEAD}(?:(?:{_CAPS}|{_TITLED}|{_OFFICE}){_END}{_NOTE}(?:\s?\.?:|\.-|\s--?(?=\s))"
    rf"|{_MIXED}{_END}{_NOTE}\.?:)(?=\s)"
)
#: A label after a finished sentence, a line break or a dash: the text runs on into another speaker.
INNER = rf"(?:(?<=[.?!…\"”)\]>}}*])\s+(?:--?\s+)?|\n\s*|\s--?\s+)(?:{LABEL})"
#: A label at the beginning of a text whose speaker is empty; there a dash may follow a name in mixed case, too.
BEGINS = rf"^\s*(?:{TIME})?\s*(?:{LABEL}|{_LEAD}{_MIXED}{_NOTE}\s--?:?(?=\s)|{_CAPS}{_NOTE}\s--?:(?=\s))"
#: What may be in a clean speaker: a name, a title, an office; typing errors within words are left to name matching.
NAME = r"^(?!SPEAKER \d)(?!Q\. (?:\S+[ ,]+\S|\S+\. ))[\p{L}\p{M}0-9][\p{L}\p{M}0-9.,'’ -]*$"
UNCLEAN = r"\.-+$|\s-+$|(?:^|\s)\d+(?:\s|$)|\d{2,}"


def _filler(text: Column) -> Column:
    """Whether a hesitation sound is in the text; ``er`` and ``um`` are words in a German sentence, ``Ah`` and ``Er`` names."""
    marked = rf"(?U)(?<![\w'’-])(?:{HESITATIONS})(?:\s?\.\.\.|…|,(?!\d)|\s--)|--\s(?:{HESITATIONS})(?![\w'’-])"
    bare = r"(?U)(?<![\w'’-])(?:uh-huh|uhh?|umm|erm|hmm?|mm|mhm|ähm?|öhm?|öh|bah euh|euh|heu)(?![\w'’-])"
    words = r"(?U)(?<![\w'’-])(?:um|er|eh|ah)(?![\w'’-])"
    german = rf"(?U)\b{_WORDS}\b.*\b{_WORDS}\b"
    begins = r"(?U)(?:^|[.?!:]\s+|[\])>}*]\s*|-\s+)(?:Uh-huh|Uhh?|Umm?|Erm|Hmm?|Mm|Mhm|Ah|Eh|Er|Ähm?|Öhm?|Öh|Bah euh|Euh|Heu)(?:,|\s?\.\.\.|…|\s--|\s(?=[\p{Lu}a-z]))"
    return text.rlike(marked) | text.rlike(bare) | (text.rlike(words) & ~text.rlike(german)) | text.rlike(begins)


def unclean_speaker(speaker: Column) -> Column:
    """Whether a speaker string holds something besides a name, title or office; an empty or null one does not."""
    s = F.coalesce(speaker, F.lit(""))
    return (F.trim(s) != "") & (~s.rlike(NAME) | s.rlike(UNCLEAN))


def turns_of(sessions: DataFrame) -> DataFrame:
    """One row per turn of ``sessions(session_id, turns)``: row_id, turn_no (from 1), speaker, text, page."""
    t = sessions.select(F.col("session_id").cast("bigint").alias("row_id"), F.posexplode("turns").alias("at", "turn"))
    return t.select(
        "row_id",
        (F.col("at") + 1).cast("bigint").alias("turn_no"),
        F.coalesce("turn.speaker", F.lit("")).alias("speaker"),
        F.coalesce("turn.text", F.lit("")).alias("text"),
        F.col("turn.page_number").alias("page"),
    )


def dirt(turns: DataFrame) -> DataFrame:
    """Kinds of dirt of each turn: row_id, turn_no, kind; a turn has a row for each kind in it."""
    before = Window.partitionBy("row_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, -1)
    text, empty = F.col("text"), F.trim("speaker") == ""
    kinds = {
        "time": text.rlike(TIME),
        "filler": _filler(text),
        "sound": text.rlike(SOUND),
        "inner": text.rlike(INNER),
        "label": F.when(empty, text.rlike(BEGINS)).otherwise(unclean_speaker(F.col("speaker"))),
        "order": F.coalesce(F.col("page") < F.max("page").over(before), F.lit(False)),
    }
    found = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in kinds.items()]))
    return turns.select("row_id", "turn_no", found.alias("kinds")).select("row_id", "turn_no", F.explode("kinds").alias("kind"))


def bare_speaker(speaker: Column) -> Column:
    """A speaker string without what is not a name, title or office; null if nothing is left."""
    s = F.regexp_replace(speaker, rf"{TIME}|(?i:\((?:continuing|through [a-z]+)\)|\[[^\]]*microphone[^\]]*\])|^\s*>>|SPEAKER \d+:|^\s*\d{{1,2}}:\d{{2}}\s", " ")
    s = F.regexp_replace(s, r"^Q\. (?=\S+[ ,]+\S|\S+\. )", "")
    s = F.regexp_replace(F.regexp_replace(s, r"[\[\]*>:(){}]", " "), r"\.-+\s*$|\s-+\s*$|:\s*$", "")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    return F.when(s != "", s)


def clean_text(text: Column) -> Column:
    """A turn's text without marks, noises and hesitations."""
    s = F.regexp_replace(F.regexp_replace(text, TIME, " "), SOUND, " ")
    bare = "uh-huh|uhh?|umm|erm|hmm?|mm|mhm|ähm?|öhm?|öh|bah euh|euh|heu"
    s = F.regexp_replace(s, rf"(?U)--\s(?:{HESITATIONS})\s--|(?<![\w'’-])(?:{HESITATIONS})(?:\s?\.\.\.|…|,(?!\d))|(?<![\w'’-])(?:{bare})(?![\w'’-])", " ")
    s = F.regexp_replace(s, r"(?U)(^|[.?!:]\s+)(?:Uh-huh|Uhh?|Umm?|Erm|Hmm?|Mm|Mhm|Ah|Eh|Er|Ähm?|Öhm?|Öh|Bah euh|Euh|Heu)(?:,|\s?\.\.\.|…)", "$1")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"\s+([,.;?!])", "$1"), r"\s+", " "))


def clean_turns(turns: DataFrame) -> DataFrame:
    """Clean, ordered turns: row_id, turn_no (from 1), speaker, page, first_turn, n_turns (joined ones), text."""
    mark = "\u0001"
    labelled = F.when(F.trim("speaker") == "", F.regexp_replace("text", rf"^\s*(?:{TIME})?\s*({LABEL})", mark + "$1\u0002")).otherwise(F.col("text"))
    cut = F.regexp_replace(labelled, rf"(?:(?<=[.?!…\"”)\]>}}*])\s+(?:--?\s+)?|\n\s*|\s--?\s+)({LABEL})", mark + "$1\u0002")
    upto = Window.partitionBy("row_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = turns.withColumn("at_page", F.last("page", ignorenulls=True).over(upto)).select(
        "row_id", "turn_no", "speaker", "at_page", F.posexplode(F.split(cut, mark)).alias("part", "piece")
    )
    has = F.contains("piece", F.lit("\u0002"))
    own = F.when(has, F.regexp_replace(F.substring_index("piece", "\u0002", 1), r"\s?\.?:$|\.-$|\s--?$", "")).when(F.col("part") == 0, F.col("speaker"))
    said = F.when(has, F.substring_index("piece", "\u0002", -1)).otherwise(F.col("piece"))
    order = ["at_page", "turn_no", "part"]
    by = Window.partitionBy("row_id").orderBy(*order)
    running = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = parts.select("row_id", *order, bare_speaker(own).alias("named"), clean_text(said).alias("text")).where(
        "text != '' or named is not null"
    )
    filled = rows.withColumn("speaker", F.coalesce(F.last("named", ignorenulls=True).over(running), F.lit(""))).where("text != ''")
    begins = F.when(F.lag("speaker").over(by).eqNullSafe(F.col("speaker")), 0).otherwise(1)
    islands = filled.withColumn("begins", begins).withColumn("island", F.sum("begins").over(running))
    texts = F.transform(F.sort_array(F.collect_list(F.struct(*order, "text"))), lambda x: x["text"])
    return islands.groupBy("row_id", F.col("island").cast("bigint").alias("turn_no")).agg(
        F.first("speaker").alias("speaker"),
        F.min("at_page").cast("bigint").alias("page"),
        F.min("turn_no").alias("first_turn"),
        F.count_distinct("turn_no").cast("bigint").alias("n_turns"),
        F.array_join(texts, " ").alias("text"),
    )
