"""Problem 5: broken pairs of a text and the answer to it."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Defects in the order in which one is chosen of several.
DEFECTS = ("empty", "refusal", "copy", "language", "truncated")
#: Answers and lead-ins that say nothing, in lower case and without outer punctuation.
NOTHING = {"", "n/a", "na", "nan", "nil", "none", "null", "empty", "no content", "no answer", "no summary", "tbd", "todo", "undefined", "summary", "here is the summary", "zusammenfassung", "hier ist die zusammenfassung", "résumé", "voici le résumé", "resumen", "aquí está el resumen", "este es el resumen"}
#: Frequent words by language.
COMMON = {
    "en": "the of and to in is that it was for on are with as his they be at this have from or had by but what all were when we there can an your which their said if will each about up how out them then she many some so these would other into has more two could no been its who now than first only after not our us",
    "de": "der die das und ist zu den dem ein eine einen nicht von mit sich auf für des im auch es an als noch wie er bei nach aus am um hat wird wurde wurden bis dass wenn werden sind war ihr wir ich nichts zum zur bleibt kann muss sein haben gegen über durch vor",
    "fr": "le la les de des du et est un une que qui dans pour pas sur au aux par plus ce cette ne se il elle nous vous ils sont été ont avec même mais comme je leur si tout rien à y a en reste sera encore cela d'abord on",
    "es": "el la los las de del y que en un una es se no por con para su al lo como más pero sus le ya o este sí porque esta entre está cuando muy sin sobre ser tiene también me hasta hay fue han queda nada una qué cómo",
    "it": "il lo gli di del della dei delle che è per con non una uno sono stato stata ha hanno alla nel nella anche più questo questa come ma se dal sul sulla degli essere ancora tutto dopo prima perché",
    "pt": "o os as do da dos das em no na nos nas um uma para por com não mais que é foi são ao à pelo pela também já mas seu sua ainda este esta isso depois antes muito tem foram ser porque",
    "nl": "de het een van en dat te op met voor niet zijn er maar om aan ook als bij nog naar dan werd wordt werden heeft hebben dit deze uit door over wel geen kan moet ze wij ons hun meer",
}
_SETS = {k: frozenset(v.split()) for k, v in COMMON.items()}
#: Each frequent word with the languages it stands for.
LANGUAGES_OF = {w: tuple(k for k, s in _SETS.items() if w in s) for s in _SETS.values() for w in s}


def _refusals() -> list[str]:
    """Patterns of a sentence that declines or asks for its input, put together by language from a speaker or a
    request as the subject, a denied ability or permission, and the task; alone, what an apology or a hint at the
    missing input says."""
    gap = r"[^.?!]{0,60}?\b"
    en_can = r"(?:can't|cannot|can not|couldn't|could not|won't|will not|would rather not|'d rather not|unable|not able|not in a position|not (?:really |currently )?(?:permitted|allowed|authori[sz]ed|comfortable|willing|prepared|equipped|something i|supposed)|decline|refuse|refrain|pass on)"
    en_task = r"(?:summar|help|assist|compl|answer|respon|process|provid|fulfil|do (?:that|this|it|so)|continu|shar|discuss|offer|produc|generat|creat|handl|support|proceed|engag|carry|recap|condens|access|work with|request|task|here|this)"
    object_ = r"(?:transcript|text|conversation|content|passage|recording|excerpt|document)"
    de_task = r"(?:zusammen|zusammengefasst|helfen|hilfe|bearbeite|verarbeite|beantworte|erfüll|machen|tun|befugt|berechtigt|autorisiert|erlaubt|gestattet|möglich|lage|liefern|leisten|weiterhelfen|ausführ|nachkommen|genug|gekürzt)"
    fr_task = r"(?:résum|aider|traiter|répondre|fournir|faire|autorisé|mesure|habilité|permis|possible|accéder|donner|satisfaire|accomplir|effectuer|réaliser|proposer|continuer|approprié|condenser)"
    es_task = r"(?:resum|ayud|proces|complet|respond|atend|proporcion|hac|describ|realiz|ofrec|cumpl|autorizad|permitid|posible|acced|continu|apropiad|facilit|dar|condens)"
    it_task = r"(?:riassum|aiut|elabor|complet|rispond|forni|fare|farlo|autorizzat|permess|possibile|grado|acced|continu|soddisf|procede|occup)"
    pt_task = r"(?:resum|ajud|process|complet|respond|atend|fornec|fazer|fazê|autorizad|permitid|possível|acess|continu|ofere|cumpr|realiz)"
    nl_task = r"(?:samenvat|samen|help|verwerk|beantwoord|doen|bevoegd|staat|toegestaan|mogelijk|uitvoer|voldoe|lever|geven|doorgaan|behandel)"
    return [
        # English
        rf"\b(?:i|i'm|i'd|i'll|i've|me|my)\b{gap}{en_can}{gap}{en_task}", rf"^\W*(?:i am |i'm |i was )?(?:unable|not (?:able|permitted|allowed|authori[sz]ed|in a position)) to\b", r"\bi'm (?:unable|not able)\b|\bi (?:\w+ )?(?:must|have to|need to) decline\b",
        r"\b(?:this|that|your|such an?|the) (?:request|task|question|prompt)\b[^.?!]*\b(?:outside|beyond|against|can't be|cannot be|can not be|not (?:permitted|allowed|appropriate|possible)|violat\w+|off limits|declined)\b", rf"\b(?:providing|summari[sz]ing|processing|helping with|answering) (?:this|that|it)\b{gap}(?:not|outside|beyond|against)\b",
        r"^\W*(?:i'm |i am |we're )?(?:very |so |truly |really |terribly )?sorry\b[^.?!]*\b(?:but|this|that|i|no|can't|cannot|unable|not)\b", r"\bmy apologies\b|\bi apologi[sz]e\b|\bas an? (?:\w+ )?(?:ai|assistant|(?:language )?model)\b|\bfor me to (?:work with|summari[sz]e)\b|\bappropriate for me\b|\bagainst (?:the rules|my guidelines|my instructions|the policy)\b|\bsomething else you would like\b",
        rf"\b(?:please|kindly|could you|can you|would you|if you)\b[^.?!]*\b(?:supply|provide|paste|attach|share|send|upload|resend)\b[^.?!]*\b{object_}\b", rf"\b(?:no|without an?y?) {object_} (?:seems|appears|was|has|is|came|to)\b|\bi (?:was|am) not given\b|\bi (?:do not|don't|did not|didn't) (?:see|have|find|receive)\b{gap}{object_}\b|\b{object_} (?:is|was|seems|appears) (?:to be )?(?:missing|empty|blank|not attached)\b",
        # German
        rf"\b(?:ich|mir|mich)\b[^.?!]*\b(?:nicht|kein\w*|nie|weder)\b[^.?!]*\b{de_task}", rf"\b(?:nicht|kein\w*)\b[^.?!]*\b(?:befugt|berechtigt|gestattet|erlaubt)\b", r"\b(?:darf|kann|werde|möchte|will|soll)\b[^.?!]{0,30}\bich\b[^.?!]*\bnicht\b", r"\bich (?:darf|werde|möchte|will|soll)\b[^.?!]{0,40}\bnicht\b", r"\bich (?:muss|möchte)\b[^.?!]*\b(?:ablehnen|passen)\b|\b(?:muss|möchte) ich\b[^.?!]*\b(?:ablehnen|passen)\b",
        r"\btut mir leid\b|\bentschuldigung\b|\bich bedauere\b|\bleider\b[^.?!]*\b(?:nicht|kein\w*)\b[^.?!]*\b(?:möglich|helfen|zusammenfassen|bearbeiten|verarbeiten|beantworten|genug)\b|\bals (?:ki|sprachmodell|sprachassistent|assistent)\w*\b|\bdiese (?:anfrage|bitte|aufgabe)\b[^.?!]*\b(?:nicht|außerhalb|gegen|übersteigt)\b",
        r"\bbitte\b[^.?!]*\b(?:sende|senden|schicke|schicken|füge|fügen|gib|geben|stelle|stellen)\b[^.?!]*\b(?:text|transkript|gespräch|inhalt|mitschrift|abschrift)\b|\bes (?:liegt|wurde|scheint) (?:mir )?kein\w*\b[^.?!]*\b(?:text|transkript|mitschrift|abschrift)\b",
        # French
        rf"\bje (?:ne |n')[^.?!]*\b(?:pas|guère|point)\b(?:[^.?!]*\b{fr_task})?", rf"\bil (?:ne )?m'est (?:impossible|pas possible|interdit)\b|\ben tant qu'|\bje (?:dois|me vois)\b[^.?!]*\b(?:refuser|décliner|m'abstenir)\b|\bdésolée?s?\b|\bje regrette\b|\bpas (?:approprié|en mesure)\b|\b(?:cette|votre) (?:demande|requête)\b[^.?!]*\b(?:dépasse|sort|pas|contraire|hors)\b",
        r"\b(?:veuillez|merci de|pourriez-vous|pouvez-vous)\b[^.?!]*\b(?:fournir|envoyer|coller|joindre|transmettre|renvoyer)\b[^.?!]*\b(?:texte|transcription|conversation|contenu)\b|\baucune? (?:texte|transcription|conversation) (?:n'|ne |jointe?)",
        # Spanish
        rf"\bno (?:puedo|podré|podría|voy a|quiero|debo|estoy|tengo|soy|logro)\b[^.?!]*\b{es_task}", rf"\bno (?:me|se me) (?:es|resulta|está|permite|permiten|corresponde)\b|\bme (?:es|resulta) imposible\b|\bme niego\b|\blo siento\b|\blamento\b|\bmis disculpas\b|\b(?:debo|tengo que) (?:rechazar|declinar)\b|\bcomo (?:un )?(?:modelo|asistente)\b|\bno (?:es|sería) apropiado\b|\b(?:esta|su|tu) (?:solicitud|petición)\b[^.?!]*\b(?:fuera|excede|no|contra)\b",
        r"\b(?:por favor|podrías?|puedes?)\b[^.?!]*\b(?:envía|enviar|proporciona|proporcionar|pega|pegar|comparte|compartir|adjunta|adjuntar|manda|facilita)\w*\b[^.?!]*\b(?:texto|transcripción|conversación|contenido)\b|\bno (?:parece|hay|se ha|he recibido)\b[^.?!]*\b(?:transcripción|texto)\b[^.?!]*\badjunt\w*",
        # Italian, Portuguese, Dutch
        rf"\bnon (?:posso|potrò|riesco|sono|ho|intendo|mi è)\b[^.?!]*\b{it_task}|\bmi (?:dispiace|scuso)\b|\bdevo (?:rifiutare|declinare)\b|\bmi è impossibile\b|\bquesta richiesta\b[^.?!]*\b(?:esula|oltre|non|contro)\b",
        rf"\bnão (?:posso|poderei|consigo|estou|tenho|sou|me é|vou)\b[^.?!]*\b{pt_task}|\b(?:sinto muito|peço desculpas?|desculpe)\b|\b(?:devo|preciso|tenho de|tenho que) (?:recusar|declinar)\b|\beste pedido\b[^.?!]*\b(?:fora|além|não|contra)\b",
        rf"\b(?:ik|mij|me)\b[^.?!]*\b(?:niet|geen)\b[^.?!]*\b{nl_task}|\bhet spijt me\b|\bhelaas (?:kan|mag) ik\b|\bik moet\b[^.?!]*\b(?:weigeren|afwijzen)\b|\bdit verzoek\b[^.?!]*\b(?:buiten|niet|tegen)\b",
    ]


REFUSAL = re.compile("|".join(f"(?:{p})" for p in _refusals()))
#: A word that every pattern above wants; most sentences have none.
DENIED = re.compile(r"n't|not\b|unable|rather|declin|refus|refrain|pass on|sorry|apolog|assistant|model|outside|beyond|against|off limits|violat|for me to|\bno\b|without|missing|empty|blank|something else|please|kindly|you\b|nicht|kein|weder|\bnie\b|leid\b|entschuldig|bedauer|\bki\b|assistent|ablehn|passen|anfrage|bitte|pas\b|point\b|guère|impossible|interdit|en tant|refuser|désol|regrette|demande|requête|veuillez|merci de|-vous|aucun|siento|lament|niego|disculpa|rechaz|modelo|asistente|apropiado|solicitud|petición|puede|podría|\bnon\b|dispiace|scuso|rifiut|richiesta|não|desculp|recus|pedido|sinto|niet|geen|spijt|helaas|weiger|afwijz|verzoek")
HEADING = re.compile(r"^\s*(?:#{1,6}\s*\S.*|\*\*[^*]+\*\*:?|__[^_]+__:?|[^\s\-*•+#>\d\[(][^.!?…:]{0,40}:)\s*$")
BULLET = re.compile(r"^\s*(?:[-*•+–]|\d+[.)])(?:\s+|$)")
FENCE = re.compile(r"^\s*(?:```|~~~)\w*\s*$")
#: Characters without width or looks.
UNSEEN = dict.fromkeys(map(ord, "\u200b\u200c\u200d\u2060\ufeff\u00ad"))
ENDED = re.compile(r"[.!?…。！？](?:[\"'”’»)\]*_`]+)?$")
WORDS = re.compile(r"\w+")
SENTENCES = re.compile(r"(?<=[.!?…])\s+")


def parts_of(answer: str) -> tuple[list[tuple[str, int]], list[str]]:
    """The headings, each with its number of content lines, and the content lines without their bullets."""
    headings: list[tuple[str, int]] = []
    lines: list[str] = []
    for line in answer.translate(UNSEEN).splitlines():
        if not line.strip() or FENCE.match(line):
            continue
        if HEADING.match(line):
            headings.append((line.strip(), 0))
            continue
        bare = BULLET.sub("", line).strip()
        if bare.lower().strip(" .:()[]*_-–…\"'`") in NOTHING:
            continue
        lines.append(bare)
        if headings:
            headings[-1] = (headings[-1][0], headings[-1][1] + 1)
    return headings, lines


def statements_of(lines: list[str]) -> list[str]:
    return [s for line in lines for s in SENTENCES.split(line) if WORDS.search(s)]


def refuses(lines: list[str]) -> bool:
    """At least half of the statements decline or ask for the input; what others did or said is no refusal."""
    said = [s.lower().replace("’", "'") for s in statements_of(lines)]
    hits = sum(bool(DENIED.search(s) and REFUSAL.search(s)) for s in said)
    return bool(said) and 2 * hits >= len(said)


def runs_covered(x: list[str], known: set, k: int) -> int:
    """The words of x that lie in runs of k words that are known."""
    reach = n = 0
    for i, run in enumerate(zip(*(x[j:] for j in range(k)))):
        if run in known:
            n += i + k - max(i, reach)
            reach = i + k
    return n


def copied(a: list[str], b: list[str], k: int = 5) -> tuple[int, float, float]:
    """Of the words of an answer and a text: the answer's that lie in runs of k words of the text, their share of
    it, and the share of the text's words that lie in runs of the answer."""
    n = runs_covered(a, set(zip(*(b[j:] for j in range(k)))), k)
    return n, n / max(1, len(a)), runs_covered(b, set(zip(*(a[j:] for j in range(k)))), k) / max(1, len(b)) if n else 0.0


def script_of(text: str) -> str:
    """The script most letters of a text belong to: LATIN, CYRILLIC and so on; empty without letters."""
    if text.isascii():
        return "LATIN" if any(c.isalpha() for c in text) else ""
    found = Counter(unicodedata.name(c, "?").split()[0] for c in text if c.isalpha() and c > "\x7f")
    found["LATIN"] += sum("a" <= c <= "z" for c in text.lower())
    return max(found, key=lambda s: (found[s], s)) if any(found.values()) else ""


def language_of(words: list[str]) -> str | None:
    """The language with most common words; null if none has two, or the next has as many."""
    get = LANGUAGES_OF.get
    n = Counter(k for w in words if (ks := get(w)) for k in ks).most_common(2)
    return n[0][0] if n and n[0][1] >= 2 and (len(n) == 1 or n[0][1] > n[1][1]) else None


def other_language(lines: list[str], text: str, words: list[str]) -> bool:
    """Script or language of the statements, the most by words, differs from the text's."""
    answer = " ".join(lines)
    a, b = script_of(answer), script_of(text)
    if a and b and a != b:
        return True
    own = language_of(words)
    if own is None or language_of(of_answer := WORDS.findall(answer.lower())) == own:
        return False
    by: Counter = Counter()
    for s in statements_of(lines):
        found = WORDS.findall(s.lower())
        by[language_of(found)] += len(found)
    known = sum(n for k, n in by.items() if k)
    return known > 0 and 2 * by[own] < known and language_of(of_answer) is not None


def heading_of(line: str) -> str:
    """A heading without its marks, in lower case."""
    return line.strip().strip("#*_: \t").lower()


def unfinished(answer: str, headings: list[tuple[str, int]], lines: list[str]) -> bool:
    """An open delimiter, an end within a sentence, or a section without content."""
    body = answer.translate(UNSEEN).strip()
    if body.count("```") % 2 or body.count("(") > body.count(")") + len(re.findall(r"(?m)^\s*\w\)", body)) or body.count("[") > body.count("]") or body.count("{") > body.count("}") or body.count("“") > body.count("”") or body.count("«") > body.count("»"):
        return True
    if not all(n for _, n in headings):
        return True
    rows = [x.strip() for x in body.splitlines() if x.strip() and not FENCE.match(x)]
    last = rows[-1] if rows else ""
    if ENDED.search(last) and not HEADING.match(last):
        return False
    # of bullets that mostly have no full stop the last needs none
    bullets = [ENDED.search(x) is None for x in rows[:-1] if BULLET.match(x)]
    return not (BULLET.match(last) and not HEADING.match(last) and len(bullets) > 1 and 2 * sum(bullets) >= len(bullets))


def judged(answer: str | None, text: str | None) -> tuple[list[str], str | None]:
    """Every defect an answer to a text has by itself, in the order of DEFECTS; an empty answer has no other. With
    them its last heading, if a section that has to come after that one would make it truncated, else null."""
    headings, lines = parts_of(answer or "")
    if not any(WORDS.search(x) for x in lines):
        return ["empty"], None
    out = []
    if refuses(lines):
        out.append("refusal")
    words = WORDS.findall(text.lower()) if text else []
    if words:
        n, of_answer, of_text = copied(WORDS.findall(answer.lower()), words)
        if n >= 20 and of_answer >= 0.6 and of_text >= 0.4:
            out.append("copy")
        if other_language(lines, text, words):
            out.append("language")
    if unfinished(answer, headings, lines):
        return [*out, "truncated"], None
    return out, heading_of(headings[-1][0]) if headings else None


def defects_of(answer: str | None, text: str | None, goes_on: frozenset[str] = frozenset()) -> list[str]:
    """Every defect of an answer to a text, in the order of DEFECTS. goes_on: the headings after which another
    section has to come."""
    out, last = judged(answer, text)
    return [*out, "truncated"] if last in goes_on else out


def headings_that_go_on(summaries: DataFrame, least_rows: int = 8, most_last: float = 0.5) -> DataFrame:
    """(heading, last) of those after which answers go on, the last heading of at most most_last of the answers that
    have them, with the number of answers that end there. Every heading of every answer is counted; one that fewer
    than least_rows answers have, however large the table, is no evidence. The rows grow with the corpus, so they
    are joined and not collected."""

    def counted(frames):
        for frame in frames:
            n: Counter = Counter()
            last: Counter = Counter()
            for a in frame["summary"]:
                found = [heading_of(h) for h, _ in parts_of(a)[0]] if isinstance(a, str) else []
                n.update(set(found))
                last.update(found[-1:])
            yield pd.DataFrame([(h, n[h], last[h]) for h in n], columns=["heading", "n", "last"])

    counts = summaries.select("summary").mapInPandas(counted, "heading string, n bigint, last bigint").groupBy("heading").agg(F.sum("n").alias("n"), F.sum("last").alias("last"))
    return counts.where((F.col("n") >= least_rows) & (F.col("last") <= most_last * F.col("n"))).select("heading", "last")


def sections_that_go_on(summaries: DataFrame, least_rows: int = 8, most_last: float = 0.5) -> frozenset[str]:
    """headings_that_go_on as a set on the driver, to look at; pair_defects joins them."""
    return frozenset(r[0] for r in headings_that_go_on(summaries, least_rows, most_last).select("heading").collect())


def with_missing_sections(found: DataFrame, go_on: DataFrame, salts: int = 16) -> DataFrame:
    """found (session_id, chunk_id, defects, heading) without the heading, truncated where it is one of go_on; only
    those where some answer ends are sent. The answers that end in the same section are spread over `salts` keys."""
    told = go_on.where(F.col("last") > 0).select(F.col("heading").alias("_h"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt_of"))
    spread = found.withColumn("_salt", F.pmod(F.hash("session_id", "chunk_id"), F.lit(salts)))
    met = spread.join(told, (F.col("heading") == F.col("_h")) & (F.col("_salt") == F.col("_salt_of")), "left")
    return met.select("session_id", "chunk_id", F.when(F.col("_h").isNull(), F.col("defects")).otherwise(F.concat("defects", F.array(F.lit("truncated")))).alias("defects"))


def pair_defects(chunks: DataFrame, summaries: DataFrame) -> DataFrame:
    """(session_id, chunk_id, defects array<string>) for every pair of chunk and summary row, sound pairs with
    an empty array.

    What sections an answer should have is taken from all answers, see headings_that_go_on. Repeated rows of a key count
    once; a chunk without summary rows, or a summary without chunk, is no pair; null keys match null keys. A
    null summary is empty; a null or empty text can't be copied or have a language. Both tables meet in one
    shuffle by key, which holds a row of each; keys, defects and last headings then meet the headings that go on.
    """
    key = ["session_id", F.col("chunk_id").cast("bigint").alias("chunk_id")]
    none = F.lit(None).cast("string")
    left = chunks.select(*key, F.col("text"), none.alias("summary"), F.lit(1).alias("has_text"), F.lit(0).alias("has_summary"))
    right = summaries.select(*key, none.alias("text"), F.col("summary"), F.lit(0).alias("has_text"), F.lit(1).alias("has_summary"))
    pairs = left.unionByName(right).groupBy("session_id", "chunk_id").agg(F.max("text").alias("text"), F.max("summary").alias("summary"), F.max("has_text").alias("t"), F.max("has_summary").alias("s")).where((F.col("t") == 1) & (F.col("s") == 1))

    def judge(frames):
        for frame in frames:
            found = [judged(a if isinstance(a, str) else None, t if isinstance(t, str) else None) for a, t in zip(frame["summary"], frame["text"])]
            yield pd.DataFrame({"session_id": frame["session_id"], "chunk_id": frame["chunk_id"], "defects": [d for d, _ in found], "heading": [h for _, h in found]})

    found = pairs.select("session_id", "chunk_id", "text", "summary").mapInPandas(judge, "session_id string, chunk_id bigint, defects array<string>, heading string")
    return with_missing_sections(found, headings_that_go_on(summaries))


def found_defects(chunks: DataFrame, summaries: DataFrame) -> DataFrame:
    """One row per defective pair with the first of its defects."""
    return pair_defects(chunks, summaries).where(F.size("defects") > 0).select("session_id", "chunk_id", F.element_at("defects", 1).alias("defect"))
