"""Problem 4: defective answers of question-answer groups.

All sentences are sorted once; an answer that breaks off without a full stop is compared with its neighbours in that
order, and is truncated if it is the beginning of one of them and equal to none. Lengths at which unusually many answers
break off, last words that end no sentence, and rules on copies, refusals and languages, do the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.canon import WORDS, fold
from granary.llm.language import LanguageModel, fit_language_model
from granary.llm.skew import attach
from granary.session import materialize

#: A length is a limit if so many answers break off there, and so many times as many as at lengths nearby.
SPIKE_LEAST = 20
SPIKE_TIMES = 8
#: An answer that ends with a word which ends hardly any sentence breaks off there.
MID_LEAST = 20
FINAL_SHARE = 0.002

#: Texts that only hold the place of an answer.
PLACEHOLDERS = frozenset(
    "none null nil na n/a nan none null. tbd todo answer answers ans pending blank empty unknown undefined placeholder text here n.a n.a. not applicable".split()
) | {"not available", "not yet available", "not provided", "not given", "no data", "no content", "no text", "no response", "tba", "to be announced", "to be provided", "no answer", "to be added", "to be filled", "answer here", "your answer", "insert answer here", "coming soon", "not applicable"}
#: Words before a repeated question.
LEAD_INS = ("you asked", "you have asked", "the question is", "question is", "the question was", "question", "answer", "q", "a", "ans", "your question")
#: Words that no sentence ends with.
OPEN_ENDS = frozenset(
    "the a an of to in on at by for from with and or but that which when if as is are was were be been has have had will would should may can must not "
    "per into than then so because since while where whereas until its their this these those each every between about under over after before least "
    "still both either within without also only very more most such".split()
)
TAG = regex.compile(r"</?[A-Za-z][^<>]*>")
SENTENCE_END = regex.compile(r"(?<=[.!?।॥])[\"'”’)\]]*\s+")
ENDED = regex.compile(r"[.!?।॥][\"'”’)\]]*\Z")
BROKEN_OFF = regex.compile(r"(?:\.{2,}|…|[,;:(\[{\-–—/])\s*\Z")
TAIL = regex.compile(r"[\s.…,;:(\[{\-–—/\"'”’)\]।॥!?]+\Z")
DIGITS = regex.compile(r"\p{Nd}+(?:[.,]\p{Nd}+)*")
BRACKETS = regex.compile(r"\([^()]*\)|\[[^\[\]]*\]")

_WHO = r"(?:\bi\b|\bwe\b|\bi'm|\bi’m|\bwe're|\bme\b|\bmodel\b|\bassistant\b|\brequest\b|\bquestion\b|\benquiry\b|\bquery\b)"
_NOT = r"(?:cannot|can't|can not|could not|couldn't|unable to|not able to|in no position to|not permitted to|not allowed to|decline to|refuse to|not possible|won't|not in a position to)"
_DO = r"(?:answer|respond|reply|advise|advice|comment|help|assist|provide|give|say|tell|discuss|find|complete|offer|recommend|share)"
#: Ways to decline, by language.
REFUSALS = [
    rf"{_WHO}.{{0,40}}{_NOT}.{{0,40}}{_DO}",
    rf"{_NOT} (?:for )?(?:me|us) to {_DO}",
    rf"(?:cannot|can't|can not|could not) be (?:answered|completed|given|processed)",
    r"something (?:i'm|i am|we are|we're) not (?:permitted|allowed|able)",
    r"\bpass on (?:this|that|the) (?:question|one)",
    r"(?:don't|do not|didn't) (?:know|have) (?:the|an|any)\b.{0,20}(?:answer|information|knowledge|details)",
    r"not have (?:enough|sufficient|any) (?:details|information|data)",
    r"\bno (?:answer|reply|response|information|advice|recommendation|data)\b.{0,60}(?:available|given|offered|provided|possible|found)",
    r"(?:gives|give|has|have|contains|contain|offers) no (?:information|answer|details)",
    r"(?:does|do|did) not (?:say|mention|contain|give|provide|cover|include|state)\b.{0,40}(?:anything|information|answer|details|point|this)",
    r"(?:beyond|outside) (?:what|the scope of what) (?:i|we)\b",
    r"as an? (?:ai|language) (?:language )?model",
    r"(?:उत्तर|जवाब) नहीं दे (?:सकत|पा)|जानकारी (?:उपलब्ध )?नहीं|उत्तर देने में असमर्थ",
    r"उत्तर देऊ शकत नाही|माहिती (?:उपलब्ध )?नाही",
    r"উত্তর দিতে পার(?:ছি|ব|ি) না|তথ্য (?:পাওয়া যায়নি|নেই)|উত্তর দেওয়া সম্ভব নয়",
    r"பதிலளிக்க (?:முடியாது|இயலாது)|பதில் (?:அளிக்க|சொல்ல|கூற) (?:முடியாது|இயலாது)|தகவல்(?:கள்)? (?:ஏதும் |எதுவும் )?இல்லை",
    r"సమాధానం (?:ఇవ్వలేను|చెప్పలేను)|సమాచారం (?:ఏదీ )?(?:లేదు|అందుబాటులో లేదు)",
    r"જવાબ (?:આપી|આપવા) (?:શક|અસમર્થ)|માહિતી (?:ઉપલબ્ધ )?નથી",
    r"ਜਵਾਬ ਨਹੀਂ ਦੇ ਸਕ|ਜਾਣਕਾਰੀ (?:ਉਪਲਬਧ |ਮੌਜੂਦ )?ਨਹੀਂ",
]
_REFUSAL = regex.compile("|".join(fold(p) for p in REFUSALS))
_REFERRAL = regex.compile(r"(?:please|kindly|try|you may|you can|contact|consult|ask)\b")


def is_empty(answer: str | None) -> bool:
    if answer is None:
        return True
    bare = fold(TAG.sub(" ", answer))
    words = WORDS.findall(bare)
    return not words or " ".join(words) in PLACEHOLDERS or "".join(bare.split()).strip(".:-[](){}<>\"'") in PLACEHOLDERS


#: Stems by which a sentence that declines is told in any wording: what denies, what is about answering or
#: knowing, and who speaks or what is asked.
DENIALS = frozenset("not cannot cant no never".split())
DENY = tuple(
    (
        "unable declin refus nothing unavailabl insufficient lack afraid sorry unfortunately regret apolog outside beyond neither hesitat "
        "नहीं नही नाही असमर्थ असमर्थता शकत না নেই অপারগ நான்முடியாது முடியாது இல்லை இயலாது தெரியாது లేదు లేను లేము లేద తెలియదు కాదు નથી નહીં અસમર્થ ਨਹੀਂ ਅਸਮਰੱਥ"
    ).split()
)
ANSWERING = tuple(
    (
        "answer repl respon advis advic comment help assist guid tell say speak recommend opinion suggest idea clue position remit scope know information info detail "
        "data sure certain aware expertise record competen authoris authoriz equipped able possible "
        "उत्तर जवाब बता सलाह सल्ला मदद मदत सहायता टिप्पणी जानकारी माहिती पता मालूम सूचना ज्ञान ठाऊक सांग উত্তর বলতে পরামর্শ সাহায্য তথ্য জান বলা பதில் ஆலோசனை உதவி உதவ தகவல் சொல்ல கூற தெரிய "
        "సమాధాన సలహా సహాయ సమాచార చెప్ప తెలియ જવાબ સલાહ મદદ માહિતી ખબર ਜਵਾਬ ਸਲਾਹ ਮਦਦ ਜਾਣਕਾਰੀ ਪਤਾ ਦੱਸ"
    ).split()
)
SPEAKER = frozenset(
    (
        "i i'm i'd i've im me my we we're we've us our ours myself assistant model bot system question query request enquiry topic "
        "मैं मुझे मेरे मेरी मुझ हम हमें हमारे हमारी मी मला माझ्या माझ्याकडे आम्ही आम्हाला आमच्या आमच्याकडे आमचे আমি আমার আমাকে আমরা আমাদের நான் எனக்கு என்னால் என்னிடம் எங்களால் எங்களிடம் எங்களுக்கு "
        "నేను నాకు నా మేము మాకు మా మావద్ద હું મને મારી મારા અમે અમને અમારી અમારા ਮੈਂ ਮੈਨੂੰ ਮੇਰੇ ਅਸੀਂ ਸਾਨੂੰ ਸਾਡੇ प्रश्न सवाल প্রশ্ন প্রশ্নের கேள்வி கேள்விக்கு ప్రశ్న ప్రశ్నకు પ્રશ્ન પ્રશ્નનો ਸਵਾਲ"
    ).split()
)
#: Small English words, which say nothing of the matter.
SMALL = frozenset(
    (
        "a an the to of on in at by for from with and or but that this these those it its is are was were be been am do does did have has had can could will would shall "
        "should may might must here there about any anything something what which who how when where why you your yours please kindly so as if than then rather such very "
        "much more most enough too just still only matter subject one one's thing case point moment present currently now give given provide provided offer share make "
        "get find found regarding concerning into out up all some really quite also yet"
    ).split()
)
DENYING = regex.compile(r"n['’]t\b")
#: Words of its own matter that a sentence which declines may have, beside those of the questions.
OWN_MATTER = 1
#: In languages without a list of small words, the share of words that have to do with declining.
OWN_SHARE = 0.34


def declines(sentence: str, asked: frozenset[str]) -> bool:
    """Whether a folded sentence denies to answer or know, and has no matter of its own beside what was asked."""
    words = regex.findall(r"[\p{L}\p{M}\p{Nd}]+(?:['’][\p{L}]+)*", sentence)
    denies = [w for w in words if w in DENIALS or w.startswith(DENY) or DENYING.search(w)]
    about = [w for w in words if w.startswith(ANSWERING) and w not in denies]
    if not denies or not about:
        return False
    if not any(w in SPEAKER for w in words) and len(words) > 4:
        return False
    told = {*denies, *about, *(w for w in words if w in SPEAKER)}
    if sentence.isascii() or sum(w.isascii() for w in words) > len(words) / 2:
        return len([w for w in words if w not in told and w not in SMALL and w not in asked]) <= OWN_MATTER
    return len([w for w in words if w in told or w in asked]) >= OWN_SHARE * len(words)


def is_refusal(answer: str, questions: list[str] = ()) -> bool:
    """Whether the answer declines and says hardly anything else: by known ways to put it, or by `declines`."""
    refused, other = False, 0
    asked = frozenset(w for q in questions for w in WORDS.findall(fold(q)))
    for sentence in SENTENCE_END.split(fold(answer).replace("’", "'")):
        if _REFUSAL.search(sentence) or declines(sentence, asked):
            refused = True
        elif not _REFERRAL.match(sentence.strip()):
            other += len(WORDS.findall(sentence))
            if other > 6:
                return False
    return refused


def is_copy(answer: str, questions: list[str]) -> bool:
    """Whether the answer only repeats questions, perhaps behind a lead-in."""
    left = " " + " ".join(WORDS.findall(fold(answer))) + " "
    asked = sorted({" ".join(WORDS.findall(fold(q))) for q in questions if q} - {""}, key=len, reverse=True)
    found = False
    for question in asked:
        while f" {question} " in left:
            left = left.replace(f" {question} ", " ", 1)
            found = True
    if not found:
        return False
    left = left.strip()
    while left:
        lead = next((x for x in LEAD_INS if left == x or left.startswith(x + " ")), None)
        if lead is None:
            return False
        left = left[len(lead) :].strip()
    return True


def masked(sentence: str) -> str:
    """A sentence for comparison: numbers alike, no brackets, single blanks, no marks at its end."""
    return TAIL.sub("", " ".join(DIGITS.sub("0", BRACKETS.sub(" ", sentence)).split()))


def last_sentence(answer: str) -> tuple[str, list[str], bool]:
    """(the last sentence, the sentences before, whether the last one ends with a full stop of any script)."""
    parts = [p for p in SENTENCE_END.split(answer.strip()) if p.strip()]
    ended = bool(ENDED.search(parts[-1].strip())) and not BROKEN_OFF.search(parts[-1])
    return parts[-1], parts[:-1], ended


#: The fragment is null unless the answer breaks off without a full stop.
_JUDGED = "group_id bigint, defects array<string>, fragment string, last_word string, cut boolean, size int"


def _judge(groups: DataFrame, model: LanguageModel) -> DataFrame:
    shared = groups.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, defects, fragments, lasts, cuts, sizes = [], [], [], [], [], []
            for id_, questions, answer in zip(*(batch.column(i).to_pylist() for i in range(3))):
                questions = [q for q in questions or () if q and q.strip()]
                fragment, final, cut, found = None, None, False, []
                if is_empty(answer):
                    found.append("empty_answer")
                elif is_copy(answer, questions):
                    found.append("copied_question")
                else:
                    if is_refusal(answer, questions):
                        found.append("refusal")
                    asked = own.whole(BRACKETS.sub(" ", " ".join(questions)))
                    given = own.whole(BRACKETS.sub(" ", answer))
                    if asked and given and asked[0] != given[0] and len(WORDS.findall(answer)) >= 3:
                        found.append("other_language")
                    last, _, ended = last_sentence(answer)
                    if not ended:
                        fragment = masked(last)
                        words = WORDS.findall(fold(fragment))
                        cut = bool(BROKEN_OFF.search(answer.rstrip())) or not words or words[-1] in OPEN_ENDS
                        final = words[-1] if words else None
                ids.append(id_)
                defects.append(found)
                fragments.append(fragment)
                lasts.append(final)
                cuts.append(cut)
                sizes.append(len(answer) if answer else 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(defects, pa.list_(pa.string())), pa.array(fragments, pa.string()), pa.array(lasts, pa.string()), pa.array(cuts, pa.bool_()), pa.array(sizes, pa.int32())],
                names=["group_id", "defects", "fragment", "last_word", "cut", "size"],
            )

    picked = groups.select(F.col("group_id").cast("bigint").alias("group_id"), "alternative_questions", F.col("authoritative_answer").alias("answer"))
    return picked.filter("group_id is not null").mapInArrow(run, _JUDGED)


def _sentences(groups: DataFrame) -> DataFrame:
    """(text): the masked sentences that end with a full stop, of all answers and quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[str] = set()
            for answer in batch.column(0).to_pylist():
                if answer and answer.strip():
                    last, before, ended = last_sentence(answer)
                    out.update(masked(s) for s in (before + [last] if ended else before))
            out.discard("")
            yield pa.RecordBatch.from_arrays([pa.array(sorted(out), pa.string())], names=["text"])

    texts = groups.select(F.col("authoritative_answer").alias("t")).unionByName(groups.select(F.col("exact_source_quote").alias("t")))
    return texts.filter("t is not null").mapInArrow(run, "text string")


def never_final(sentences: DataFrame) -> DataFrame:
    """(last_word): words that stand within sentences often, MID_LEAST times or more, and hardly ever at their end."""
    words = sentences.select(F.split(F.lower("text"), " ").alias("w"))
    each = words.select(F.posexplode("w").alias("at", "word"), F.size("w").alias("n")).select("word", (F.col("at") == F.col("n") - 1).cast("long").alias("final"))
    counts = each.groupBy("word").agg(F.sum("final").alias("final"), F.count(F.lit(1)).alias("n"))
    return counts.filter((F.col("n") >= MID_LEAST) & (F.col("final") <= FINAL_SHARE * F.col("n"))).select(F.col("word").alias("last_word"))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over sentences in sorted order: each fragment with the next whole sentence.

    Gives (part, text, state): state 1 if the fragment begins a longer sentence, 0 if it is a whole one or begins none,
    2 if its next sentence lies in a later partition; and a row of state 3 with the first whole sentence of the part.
    """
    part = TaskContext.get().partitionId()
    out: list[tuple[str, int]] = []
    waiting: list[str] = []
    last, first = None, None
    for batch in batches:
        for text, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if whole:
                if first is None:
                    first = text
                out.extend((f, int(text.startswith(f))) for f in waiting)
                waiting, last = [], text
            elif text == last:
                out.append((text, 0))
            else:
                waiting.append(text)
    out.extend((f, 2) for f in waiting)
    if first is not None:
        out.append((first, 3))
    for at in range(0, len(out), 8192):
        texts, states = zip(*out[at : at + 8192])
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(texts), pa.int32()), pa.array(texts, pa.string()), pa.array(states, pa.int32())], names=["part", "text", "state"])


def shortened_fragments(fragments: DataFrame, sentences: DataFrame) -> DataFrame:
    """(fragment): the different fragments that are the beginning of a longer sentence and equal to none.

    One global sort by range partitions; only the first sentence of each partition goes to the driver, for the fragments
    at the partitions' ends.
    """
    both = sentences.select("text", F.lit(1).alias("whole")).unionByName(fragments.select(F.col("fragment").alias("text"), F.lit(0).alias("whole")))
    both = both.groupBy("text", "whole").agg(F.count(F.lit(1)).alias("n")).drop("n")
    parts = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = both.repartitionByRange(parts, "text").sortWithinPartitions("text", F.desc("whole"))
    seen = materialize(ordered.mapInArrow(_neighbours, "part int, text string, state int"), "neighbours")
    firsts = sorted((r["part"], r["text"]) for r in seen.filter("state = 3").select("part", "text").collect())
    known = seen.filter("state = 1").select(F.col("text").alias("fragment"))
    if not firsts:
        return known
    nearest = [(p, min(f for f in firsts if f[0] > p)[1]) for p in range(parts) if firsts[-1][0] > p]
    following = both.sparkSession.createDataFrame(nearest, "part int, next string")
    edge = seen.filter("state = 2").join(F.broadcast(following), "part").filter("startswith(next, text)").select(F.col("text").alias("fragment"))
    return known.unionByName(edge)


def length_limits(broken: DataFrame) -> DataFrame:
    """(size): lengths at which far more answers break off than at the ten lengths on either side."""
    counts = broken.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    near = counts.select(F.explode(F.sequence(F.col("size") - 10, F.col("size") + 10)).alias("at"), F.col("size").alias("from"), "n")
    around = near.groupBy("at").agg(F.sum(F.when(F.col("at") == F.col("from"), F.col("n"))).alias("here"), F.sum("n").alias("all"))
    mean = (F.col("all") - F.col("here")) / 20
    return around.filter((F.col("here") >= SPIKE_LEAST) & (F.col("here") >= SPIKE_TIMES * mean)).select(F.col("at").alias("size"))


def judge_pairs(groups: DataFrame, model: LanguageModel) -> DataFrame:
    """(group_id BIGINT, defect STRING): one row for each group and defect.

    Null, blank and placeholder answers are empty and nothing else; null or empty question lists can't be copied nor
    differ in language; rows without group_id are left out; a repeated row gives its defects once; extra columns are
    ignored.
    """
    judged = materialize(_judge(groups, model), "judged")
    broken = judged.filter("fragment is not null")
    counts = broken.groupBy("fragment").agg(F.count(F.lit(1)).alias("n"))
    sentences = materialize(_sentences(groups).distinct(), "sentences")
    shorter = shortened_fragments(counts.select("fragment"), sentences).withColumn("shorter", F.lit(True))
    whole = sentences.select(F.col("text").alias("fragment"), F.lit(True).alias("whole"))
    states = counts.join(shorter.distinct(), "fragment", "left").join(whole, "fragment", "left")
    states = materialize(states.select("fragment", "n", F.coalesce("shorter", F.lit(False)).alias("shorter"), F.coalesce("whole", F.lit(False)).alias("whole")), "states")
    marked = attach(broken.select("fragment", "group_id", "last_word", "cut", "size"), "fragment", states, "n", broken.count())
    limits = length_limits(broken).withColumn("limited", F.lit(True))
    opened = never_final(sentences).withColumn("opened", F.lit(True))
    doubtful = marked.filter("not whole").join(limits, "size", "left").join(opened, "last_word", "left")
    truncated = doubtful.filter("shorter or cut or limited or opened").select("group_id", F.lit("truncated_answer").alias("defect"))
    ruled = judged.select("group_id", F.explode("defects").alias("defect"))
    return ruled.unionByName(truncated).distinct()


def find_defects(groups: DataFrame, documents: DataFrame) -> DataFrame:
    """`judge_pairs` with a language model fit on the documents."""
    return judge_pairs(groups, fit_language_model(documents))
