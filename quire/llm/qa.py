"""Problem 4: broken prompt and response pairs, with their defect.

Method: a linear-chain conditional random field tags every clause of a response as
answer, refusal, echo, foreign or unfinished; the share of the clauses that each tag
covers gives the defect of the pair.  The field is trained on a bounded sample of the
pairs themselves: sound answers as they are, and the same answers cut off, echoed,
refused, exchanged for one in another language, or left without a full stop.

Whether a clause without final mark is complete is asked of the whole table: how
often its last word, and its last two words, end a clause in all answers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.cut import cut
from quire.llm.abuse import fold
from quire.llm.canonical import canonical_text
from quire.llm.language import LANGUAGE_NAMES, LanguageModel, widen, words_of

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)

# Texts that stand for no answer (folded, without brackets and quotes).
PLACEHOLDERS = frozenset("n/a|n.a.|na|nan|null|nil|none|tbd|tba|tbc|todo|to do|to be done|to be defined|answer|antwort|reponse|respuesta|risposta|antwoord|resposta|placeholder|undefined|unknown|empty|leer|vide|vacio|k.a.|k. a.|s.o.|xxx|xx|lorem ipsum|insert answer here|no data".split("|"))

# Words of which refusals are made, in seven languages (folded); "*" for any ending.
CUES = {
    "negation": "not no never cannot cant dont wont couldnt wouldnt isnt arent doesnt nothing none nobody without neither nor nicht nichts kein* nie niemals ohne ne n pas aucun* rien jamais sans ni ningun* nada nunca sin non nessun* niente nulla mai senza niet niets geen nooit zonder nao nenhum* nem sem",
    "self": "i m me my mine myself mes prefiero prefiro preferisco we us our ich mir mich mein* wir uns unser* je j me moi mon mes nous notre yo mi mis conmigo nosotros nuestr* io mio mia miei noi nostr* ik mij mijn wij ons onze eu mim meu minha meus minhas comigo nos nosso*",
    "able": "can could able may might must allowed permitted possible cannot unable kann konnen konnte darf durfen muss moglich unmoglich gestattet erlaubt vermag peux peut pouvons pouvez permis permise possible impossible autorise* dois puedo podemos puede posible imposible permitid* debo tengo posso possiamo possibile impossibile consentit* permess* devo kan kunnen kon mag mogen mogelijk onmogelijk toegestaan moet posso podemos possivel impossivel permitid* devo tenho lecito",
    "tell": "answer* help* assist* say tell* comment* know knows known knowledge information idea clue mention* respond* reply opinion advise speak discuss state address deal antwort* beantwort* helf* hilfe weiterhelf* sag* sagen auskunft weiss wissen ahnung angaben information* kenntnis* mitteil* aussern ausser* stellung erklar* beurteil* repond* reponse* aide* aider dire dis sais sait savoir savons connais* connaissance* information* idee renseign* prononcer commenter traiter avis respond* respuesta* contest* ayud* decir digo saber sabemos conozco conocimiento* informacion idea dato datos opinar comentar tratar rispond* rispost* aiut* dire dico sapere sappiamo conosco conoscenz* informazion* idea dati pronunciar* commentar* trattar* antwoord* beantwoord* help* zeggen zeg weet weten kennis informatie gegevens idee mening uitlat* ingaan respond* respost* ajud* dizer digo sei saber sabemos conheco conhecimento* informac* ideia dados opinar comentar tratar pronunciar*",
    "asked": "interrog* consult* adress* wenden turn contact* contatt* raadple* question* request* query topic* subject* matter inquiry frage* anfrage* thema themen bitte wunsch question* demande* sujet* requete* theme* pregunta* peticion* consulta* tema* asunto domand* richiest* tem* argoment* vraag vragen verzoek* onderwerp* kwestie pergunta* pedido* tema* assunto* questao questoes",
    "source": "document* documentation manual* text* material* source* record* database access unterlagen dokument* handbuch handbuch* texte* texten quelle* zugriff material* documentation document* manuel* texte* source* acces documento* documentacion manual* texto* fuente* acceso document* documentazione manual* test* font* accesso document* documentatie handleiding* tekst* bron bronnen toegang document* documentacao manual* texto* fonte* acesso",
    "regret": "sorry unfortunately regret* afraid apolog* leider bedau* leid entschuldig* desole* malheureusement regrett* navre* pardon* siento lamentablemente desgracia* lamento disculp* desafortunadamente perdon dispiace purtroppo spiacent* scus* helaas spijt* excuses jammer infelizmente sinto lament* desculp* lastima",
    "decline": "declin* refus* reject* rather pass withhold open ablehn* verweiger* zuruckweis* offen enthalt* declin* refus* abstien* ouverte rechaz* rehus* neg* abierta declin* rifiut* aperta preferisco astengo afwijz* weiger* liever open recus* declin* prefiro aberto aberta abstenho prefer* lieber",
    "role": "assistant* ai instruction* administrator* specialist* expert* supervisor guideline* policy beyond assistent* ki anweisung* administrator* fachkraft fachkrafte fachmann richtlinie* zustandig* ubersteig* assistant* ia consigne* administrateur* specialiste* expert* depass* outrepass* asistente* instruccion* administrador* especialista* expert* supera* assistente* istruzion* amministrator* specialista* espert* supera* instructies beheerder* specialist* deskundig* boven assistente* instruc* administrador* especialista* ultrapass* perito*",
    "courtesy": "thank* thanks welcome danke* dank merci gracias grazie bedankt dank obrigad* else sonst autre algo altro nog mais anything ask gern* gerne souhaitez desea desidera wilt deseja",
}
# Pairs of words that say "I know", where the second alone is a common word.
KNOW_PAIRS = frozenset({("lo", "so"), ("lo", "se"), ("non", "so")})
_CUE = {}
_STEMS: dict[str, int] = {}
for _bit, _words in enumerate(CUES.values()):
    for _w in _words.split():
        into = _STEMS if _w.endswith("*") else _CUE
        into[_w.rstrip("*")] = into.get(_w.rstrip("*"), 0) | 1 << _bit
CUE_BIT = {name: 1 << i for i, name in enumerate(CUES)}


@lru_cache(200_000)
def cues_of(word: str) -> int:
    """The classes of a folded word, as bits."""
    bits = _CUE.get(word, 0)
    for n in range(3, len(word) + 1):
        bits |= _STEMS.get(word[:n], 0)
    return bits


def clause_cues(folded: str) -> tuple[int, int]:
    """The classes that the words of a clause have, as bits, and how many words have one."""
    bits = count = 0
    words = _CUE_WORD.findall(folded.replace("n't", " not").replace("n’t", " not"))
    for before, w in zip(["", *words], words):
        b = cues_of(w)
        if (before, w) in KNOW_PAIRS:
            b |= CUE_BIT["self"] | CUE_BIT["tell"]
        bits |= b
        count += b > 0
    return bits, count


def refuses(folded: str) -> bool:
    """Whether a clause looks like a refusal, for keeping such out of the sound answers for training."""
    bits, _ = clause_cues(folded)
    has = lambda *names: all(bits & CUE_BIT[n] for n in names)
    return has("self", "negation", "tell") or has("regret", "negation") or has("regret", "decline") or has("self", "decline") or has("self", "negation", "able")


_QUOTED = re.compile(r"\"[^\"]{3,120}\"|“[^”]{3,120}”|«[^»]{3,120}»|„[^“]{3,120}“")
_CLAUSE = re.compile(r"(?<=[.!?…])[\"'”»)]*\s+(?!$)|\s*\n+\s*")
_BULLET = re.compile(r"(?:[-*•–]|\(?\d{1,3}[.)])\s*")
_WORD = re.compile(r"[^\W_]+(?:[-–']\w+)*")
_CUE_WORD = re.compile(r"[^\W\d_]+")
_FINAL = re.compile(r"[.!?][\"'”»)\]]*$|[;:]\s*$")
_BREAK_OFF = re.compile(r"(?:…|\.{3,})$")
_LETTER = re.compile(r"[^\W\d_]")
_BRACKETS = "[]{}()<>\"'“”«»„`*_#~ \t\n"

def breaks_off(clause: str) -> bool:
    """Whether a clause ends in dots, or is the number or bullet of an item that does not follow."""
    return bool(_BREAK_OFF.search(clause) or _BULLET.fullmatch(clause))


def is_final(clause: str) -> bool:
    """Whether a clause has a final mark, or is an aside of its own in brackets or quotes."""
    return not breaks_off(clause) and bool(_FINAL.search(clause)) or (clause[0] in "([«“\"" and clause[-1] in ")]»”\"")


LANGUAGE_STEMS = {fold(n)[: max(5, len(n) - 2)]: code for code, names in LANGUAGE_NAMES.items() for n in names.split() if len(n) >= 5}


def is_empty(answer: str | None) -> bool:
    """Null, blank, invisible, or only a placeholder."""
    if answer is None:
        return True
    text = fold(canonical_text(answer)).strip()
    core = text.strip(_BRACKETS).rstrip(".:!")
    return not re.search(r"[^\W_]", text) or core in PLACEHOLDERS or text in PLACEHOLDERS


def clauses_of(answer: str) -> list[str]:
    """Sentences and list items; a bullet goes with its item, a wrapped line with its sentence."""
    out: list[str] = []
    for part in _CLAUSE.split(canonical_text(answer).strip()):
        part = part.strip()
        if not part:
            continue
        if out and _BULLET.fullmatch(out[-1]):
            out[-1] += " " + part
        else:
            out.append(part)
    return out


def last_keys(clause: str) -> tuple[str, str]:
    """Keys of the last word and of the last two words of a clause; figures, codes and names by their kind."""
    found = _WORD.findall(clause)[-2:]
    kinds = []
    for i, w in enumerate(found):
        if any(c.isdigit() for c in w):
            kinds.append("#code" if any(c.isalpha() for c in w) else "#figure")
        else:
            kinds.append(fold(w))
    if not kinds:
        return "", ""
    return kinds[-1], " ".join(kinds) if len(kinds) == 2 else "^ " + kinds[-1]


def all_keys(clause: str) -> tuple[Counter, Counter]:
    """How often each word and pair of words occurs in a clause, and which of them end it."""
    kinds = ["#code" if any(c.isalpha() for c in w) and any(c.isdigit() for c in w) else "#figure" if any(c.isdigit() for c in w) else fold(w) for w in _WORD.findall(clause)]
    every = Counter(kinds)
    every.update(f"{a} {b}" for a, b in zip(["^", *kinds], kinds))
    ends = Counter([kinds[-1], f"{kinds[-2] if len(kinds) > 1 else '^'} {kinds[-1]}"]) if kinds else Counter()
    return every, ends


FEATURES = (
    "bias first last only negation self able tell asked source regret decline role courtesy negation_tell self_negation self_negation_tell self_negation_able self_decline asked_decline regret_negation regret_other negation_source "
    "role_self role_other dense denser few echo60 echo80 echo95 covers80 foreign other_answer same_language unfinal breaks_off comma "
    "end1_never end1_rare end1_often end2_never end2_rare end2_often end2_unseen word_unknown name_unknown quoted short"
).split()
_F = {name: i for i, name in enumerate(FEATURES)}


def features(question: str, clauses: list[str], q_lang: int, c_langs: list[int], a_lang: int, ends: tuple | None) -> np.ndarray:
    """One row of features per clause.

    ``ends``: occurrences and clause ends of the last word and the last two words of
    the answer, where it has no final mark.
    """
    x = np.zeros((len(clauses), len(FEATURES)), np.float32)
    asked = set(words_of(fold(question)))
    for i, clause in enumerate(clauses):
        folded = fold(clause)
        bare = _QUOTED.sub(" ", folded) if i or len(clauses) > 1 else folded
        row = x[i]
        row[_F["bias"]] = 1
        row[_F["first"]], row[_F["last"]], row[_F["only"]] = i == 0, i == len(clauses) - 1, len(clauses) == 1
        row[_F["quoted"]] = bare != folded
        words = set(words_of(folded.replace('"', " ").replace("«", " ").replace("»", " ").replace("(", " ")))
        if words and asked:
            common = len(words & asked)
            for level in (60, 80, 95):
                row[_F[f"echo{level}"]] = common >= level / 100 * len(words)
            row[_F["covers80"]] = common >= 0.8 * len(asked)
            if common >= 0.8 * len(words) and common >= 0.5 * len(asked):
                bare = ""  # the words are the question's own
        bits, count = clause_cues(bare)
        have = {name: bool(bits & bit) for name, bit in CUE_BIT.items()}
        for name, value in have.items():
            row[_F[name]] = value
        row[_F["negation_tell"]] = have["negation"] and have["tell"]
        row[_F["self_negation"]] = have["self"] and have["negation"]
        row[_F["self_negation_tell"]] = have["self"] and have["negation"] and have["tell"]
        row[_F["self_negation_able"]] = have["self"] and have["negation"] and have["able"]
        row[_F["self_decline"]] = have["self"] and have["decline"]
        row[_F["asked_decline"]] = have["asked"] and have["decline"]
        row[_F["regret_negation"]] = have["regret"] and have["negation"]
        row[_F["regret_other"]] = have["regret"] and (have["decline"] or have["tell"] or have["asked"] or have["able"])
        row[_F["negation_source"]] = have["negation"] and have["source"]
        row[_F["role_self"]] = have["role"] and have["self"]
        row[_F["role_other"]] = have["role"] and (have["negation"] or have["tell"] or have["asked"] or have["able"])
        n_words = len(_CUE_WORD.findall(bare))
        row[_F["dense"]], row[_F["denser"]], row[_F["few"]] = count >= 0.3 * n_words, count >= 0.5 * n_words, n_words <= 5
        row[_F["short"]] = len(words) < 3
        if q_lang >= 0:
            row[_F["foreign"]] = c_langs[i] >= 0 and c_langs[i] != q_lang
            row[_F["other_answer"]] = a_lang >= 0 and a_lang != q_lang
            row[_F["same_language"]] = c_langs[i] == q_lang
    tail = clauses[-1] if clauses else ""
    if tail and not is_final(tail):
        row = x[-1]
        row[_F["unfinal"]], row[_F["breaks_off"]] = 1, breaks_off(tail)
        row[_F["comma"]] = tail[-1] in ",-–—(/«\"“'&+" or tail.count("(") > tail.count(")") or tail.count("«") > tail.count("»")
        seen1, end1, seen2, end2 = ends or (0, 0, 0, 0)
        # This occurrence itself is no evidence.
        seen1, end1, seen2, end2 = max(0, seen1 - 1), max(0, end1 - 1), max(0, seen2 - 1), max(0, end2 - 1)
        word = (_WORD.findall(tail) or [""])[-1]
        if seen1 < 2:
            row[_F["name_unknown" if word[:1].isupper() else "word_unknown"]] = 1
        else:
            share = end1 / seen1
            row[_F["end1_never" if share < 0.01 else "end1_rare" if share < 0.12 else "end1_often"]] = 1
        if seen2 < 2:
            row[_F["end2_unseen"]] = 1
        else:
            share = end2 / seen2
            row[_F["end2_never" if share < 0.01 else "end2_rare" if share < 0.12 else "end2_often"]] = 1
    return x


@dataclass
class ChainField:
    """A linear-chain conditional random field: ``emit`` (features x tags) and ``move`` (tags x tags)."""

    emit: np.ndarray
    move: np.ndarray

    def decode(self, x: np.ndarray) -> list[int]:
        """The most probable tags of one sequence (Viterbi)."""
        score = x @ self.emit
        best, back = score[0], []
        for row in score[1:]:
            paths = best[:, None] + self.move
            back.append(paths.argmax(0))
            best = paths.max(0) + row
        tags = [int(best.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]

    @staticmethod
    def fit(sequences: list[tuple[np.ndarray, list[int]]], rounds: int = 150, rate: float = 0.15, decay: float = 2e-4) -> ChainField:
        """Maximum likelihood by forward-backward and Adam over all sequences at once; deterministic."""
        k = len(TAGS)
        longest = max(len(y) for _, y in sequences)
        n = len(sequences)
        x = np.zeros((n, longest, len(FEATURES)), np.float32)
        y = np.zeros((n, longest), np.int64)
        mask = np.zeros((n, longest), np.float32)
        for i, (xs, ys) in enumerate(sequences):
            x[i, : len(ys)], y[i, : len(ys)], mask[i, : len(ys)] = xs, ys, 1
        gold = np.eye(k, dtype=np.float32)[y] * mask[..., None]
        flat = x.reshape(-1, len(FEATURES))
        seen_emit = flat.T @ gold.reshape(-1, k)
        seen_move = np.einsum("ntj,ntk->jk", gold[:, :-1], gold[:, 1:])
        emit, move = np.zeros((len(FEATURES), k)), np.zeros((k, k))
        state = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(move), np.zeros_like(move)]

        for step in range(1, rounds + 1):
            s = (flat @ emit.astype(np.float32)).reshape(n, longest, k)
            e, jump = np.exp(s - s.max(2, keepdims=True)), np.exp(move).astype(np.float32)
            # Scaled forward and backward messages; positions behind the end pass them on unchanged.
            fwd = [e[:, 0] / e[:, 0].sum(1, keepdims=True)]
            scale = [None]
            for t in range(1, longest):
                new = (fwd[-1] @ jump) * e[:, t]
                c = new.sum(1, keepdims=True)
                inside = mask[:, t, None] > 0
                fwd.append(np.where(inside, new / c, fwd[-1]))
                scale.append(c)
            bwd = np.ones((n, k), np.float32)
            p = np.empty_like(s)
            pair = np.zeros((k, k))
            for t in range(longest - 1, -1, -1):
                both = fwd[t] * bwd
                p[:, t] = both / both.sum(1, keepdims=True) * mask[:, t, None]
                if t:
                    out = np.where(mask[:, t, None] > 0, e[:, t] * bwd / scale[t], 0)
                    pair += (fwd[t - 1].T @ out) * jump
                    bwd = np.where(mask[:, t, None] > 0, out @ jump.T, bwd)
            for w, grad, m, v in ((emit, (seen_emit - flat.T @ p.reshape(-1, k)) / n - decay * emit, *state[:2]), (move, (seen_move - pair) / n - decay * move, *state[2:])):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad**2
                w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return ChainField(emit, move)


def language_scores(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """The cosine of each text with the nearest centroid of every language; 0 for texts too short to tell."""
    words = [words_of(t) for t in texts]
    firsts = np.flatnonzero(np.concatenate([[True], model.owner[1:] != model.owner[:-1]]))
    sims = [np.maximum.reduceat(model.cosines(words[a : a + 4096]), firsts, axis=1) for a in range(0, len(words), 4096)]
    top = np.concatenate(sims) if sims else np.zeros((0, len(firsts)))
    top[[len(w) < model.min_words for w in words]] = 0
    return top


def other_than(question: np.ndarray, text: np.ndarray, gap: float = 0.05) -> int:
    """The language of ``text`` seen from the question: another one only where both scores clearly say so.

    Returns -1 where the text is too short to tell.
    """
    mine, yours = int(question.argmax()), int(text.argmax())
    if not text.any() or not question.any():
        return -1
    if mine != yours and (question[mine] - question[yours] < gap or text[yours] - text[mine] < gap):
        return mine
    return yours


def tag_batch(rows: list[tuple[str, str, tuple | None]], model: LanguageModel, field: ChainField | None) -> list:
    """For each (question, answer, ends): (clauses, features or tags, question's and answer's language)."""
    split = [clauses_of(a) for _, a, _ in rows]
    flat = [c for cs in split for c in cs]
    scores = language_scores(model, [q for q, _, _ in rows] + [" ".join(_QUOTED.sub(" ", c) for c in cs) for cs in split] + flat)
    out, at = [], 2 * len(rows)
    for i, ((q, _, ends), cs) in enumerate(zip(rows, split)):
        mine = scores[i]
        asked = int(mine.argmax()) if mine.any() else -1
        answer = other_than(mine, scores[len(rows) + i])
        x = features(q, cs, asked, [other_than(mine, scores[at + j]) for j in range(len(cs))], answer, ends)
        at += len(cs)
        out.append((cs, field.decode(x) if field and cs else x, asked, answer))
    return out


def asked_languages(question: str) -> set[str]:
    """The languages that a question names."""
    return {code for w in _WORD.findall(fold(question)) for stem, code in LANGUAGE_STEMS.items() if w.startswith(stem)}


def defect_of(question: str, clauses: list[str], tags: list[int], q_lang: int, a_lang: int, names: list[str]) -> str | None:
    """The first defect that the coverage of the clauses shows, or None."""
    if not clauses:
        return "empty"
    weight = [max(1, len(words_of(c))) for c in clauses]
    share = [sum(w for w, t in zip(weight, tags) if t == k) / sum(weight) for k in range(len(TAGS))]
    if share[ECHO] == 1:
        return "copied"
    if share[REFUSAL] > 0 and share[REFUSAL] + share[ECHO] == 1:
        return "refusal"
    if share[FOREIGN] >= 0.5 and (a_lang < 0 or names[a_lang] not in asked_languages(question)):
        return "other_language"
    if tags[-1] == UNFINISHED:
        return "truncated"
    return None


# Examples of refusals for training, one line per language.
TRAINING_REFUSALS = {
    "en": "Nothing can be said about that.|No answer can be given on this point.|I'm sorry, but I can't help with that.|I don't know.|I have no idea.|No comment.|I cannot answer this question.|Unfortunately I have to decline this request.|We are not able to say anything about it.|As an assistant I may not answer questions of this kind.|There is nothing I could say about this.|No information on this is known to me.|Please ask an expert, I have no access to such knowledge.|I would rather not comment on this topic.|That goes beyond what I am allowed to discuss.|The texts do not mention it, so I must leave this open.|It is impossible for me to judge this.|I refuse to answer.",
    "de": "Dazu kann nichts gesagt werden.|Zu dieser Stelle ist keine Aussage möglich.|Es tut mir leid, dazu kann ich keine Auskunft geben.|Ich weiß es nicht.|Keine Ahnung.|Davon habe ich keine Kenntnis.|Leider muss ich diese Anfrage ablehnen.|Dazu können wir nichts sagen.|Als Assistent darf ich das nicht beantworten.|Darüber liegen mir keine Angaben vor, ich muss die Frage offen lassen.|Bitte fragen Sie einen Experten, mir fehlt das Wissen dazu.|Das übersteigt, was ich sagen darf.|In den Texten steht darüber nichts.|Es ist mir nicht möglich, das zu beurteilen.|Dazu möchte ich mich lieber nicht äußern.|Kein Kommentar.",
    "fr": "On ne peut rien dire là-dessus.|Aucune réponse n'est possible sur ce point.|Je suis désolé, mais je ne peux pas répondre à cela.|Je ne sais pas.|Aucune idée.|Je n'en sais rien.|Malheureusement, je dois décliner cette demande.|Nous ne pouvons rien dire à ce sujet.|En tant qu'assistant, il ne m'est pas permis de traiter ce sujet.|Je n'ai aucune information à ce sujet.|Demandez à un expert, je n'ai pas ces connaissances.|Cela dépasse ce que je peux dire.|Les documents n'en disent rien.|Il m'est impossible d'en juger.|Je préfère ne pas donner mon avis.|Je dois laisser la question ouverte.",
    "es": "No se puede decir nada sobre eso.|Sobre este punto no es posible dar respuesta.|Lo siento, pero no puedo ayudar con esa consulta.|No lo sé.|Ni idea.|No tengo ni idea.|Por desgracia tengo que rechazar esta petición.|No podemos decir nada al respecto.|Como asistente no me está permitido tratar este tema.|No dispongo de datos al respecto.|Pregunte a un experto, me falta ese conocimiento.|Eso supera lo que puedo decir.|Los textos no dicen nada de eso.|Me es imposible juzgarlo.|Prefiero no dar mi opinión.|Debo dejar la pregunta abierta.",
    "it": "Non si può dire nulla su questo.|Su questo punto non è possibile dare risposta.|Mi dispiace, ma non posso aiutare con questa richiesta.|Non lo so.|Nessuna idea.|Non ne ho idea.|Purtroppo devo declinare questa domanda.|Non possiamo dire nulla al riguardo.|Come assistente non mi è consentito trattare questo tema.|Non dispongo di dati in merito.|Chieda a un esperto, mi manca questa conoscenza.|Questo supera ciò che posso dire.|I documenti non ne parlano.|Mi è impossibile giudicarlo.|Preferisco non dare la mia opinione.|Devo lasciare aperta la domanda.",
    "nl": "Daar kan niets over worden gezegd.|Over dit punt is geen antwoord mogelijk.|Het spijt me, maar daar kan ik niet bij helpen.|Ik weet het niet.|Geen idee.|Daar weet ik niets van.|Helaas moet ik dit verzoek afwijzen.|Daar kunnen wij niets over zeggen.|Als assistent mag ik dit soort vragen niet beantwoorden.|Daarover heb ik geen gegevens.|Vraag het een deskundige, mij ontbreekt die kennis.|Dat gaat boven wat ik mag zeggen.|In de teksten staat daar niets over.|Het is mij onmogelijk dit te beoordelen.|Ik geef liever geen mening.|Ik moet de vraag open laten.",
    "pt": "Nada se pode dizer sobre isso.|Sobre este ponto não é possível dar resposta.|Sinto muito, mas não posso ajudar com esse pedido.|Não sei.|Não faço ideia.|Não sei nada sobre isso.|Infelizmente tenho de recusar esta pergunta.|Não podemos dizer nada a respeito.|Como assistente não me é permitido tratar deste assunto.|Não disponho de dados a esse respeito.|Pergunte a um perito, falta-me esse conhecimento.|Isso ultrapassa o que posso dizer.|Os textos nada dizem sobre isso.|É-me impossível julgar isso.|Prefiro não dar a minha opinião.|Tenho de deixar a pergunta em aberto.",
}
TRAINING_COURTESY = {"en": "Thank you for your question.|Is there anything else you would like to know?", "de": "Danke für Ihre Frage.|Gibt es sonst noch etwas, das Sie wissen möchten?", "fr": "Merci pour votre question.|Souhaitez-vous savoir autre chose ?", "es": "Gracias por su pregunta.|¿Desea saber algo más?", "it": "Grazie per la domanda.|Desidera sapere altro?", "nl": "Dank voor uw vraag.|Wilt u verder nog iets weten?", "pt": "Obrigado pela pergunta.|Deseja saber mais alguma coisa?"}


# Short answers that are complete, for training.
TRAINING_PLAIN = {
    "en": "You must not open the cover while it runs.|The operator cannot change this setting.|No, nobody needs a permit for it.|We never print without a proof.|The manual does not allow any other oil.|Nothing has to be adjusted.|If you do not know the code, ask the clerk.|Unfortunately the old pump is not delivered any more.|The request is rejected when the code is missing.|My colleague and I check it every day.",
    "de": "Sie dürfen die Haube im Lauf nicht öffnen.|Der Bediener kann diese Einstellung nicht ändern.|Nein, niemand braucht dafür eine Genehmigung.|Wir drucken nie ohne Andruck.|Das Handbuch erlaubt kein anderes Öl.|Es muss nichts eingestellt werden.|Die alte Pumpe wird leider nicht mehr geliefert.|Die Anfrage wird abgelehnt, wenn der Schlüssel fehlt.",
    "fr": "Il ne faut pas ouvrir le capot en marche.|L'opérateur ne peut pas changer ce réglage.|Non, personne n'a besoin d'un permis.|Nous n'imprimons jamais sans épreuve.|Le manuel n'autorise aucune autre huile.|Rien n'est à régler.|La demande est refusée quand la clé manque.",
    "es": "No se debe abrir la tapa en marcha.|El operario no puede cambiar este ajuste.|No, nadie necesita permiso.|Nunca imprimimos sin prueba.|El manual no permite otro aceite.|No hay que ajustar nada.|La petición se rechaza cuando falta la clave.",
    "it": "Non si deve aprire il coperchio in marcia.|L'operatore non può cambiare questa impostazione.|No, nessuno ha bisogno di un permesso.|Non stampiamo mai senza prova.|Il manuale non permette un altro olio.|Non c'è nulla da regolare.|La richiesta viene rifiutata quando manca la chiave.",
    "nl": "U mag de kap tijdens het lopen niet openen.|De operator kan deze instelling niet wijzigen.|Nee, niemand heeft een vergunning nodig.|Wij drukken nooit zonder proef.|De handleiding staat geen andere olie toe.|Er hoeft niets te worden ingesteld.|Het verzoek wordt geweigerd als de sleutel ontbreekt.",
    "pt": "Não se deve abrir a tampa em marcha.|O operador não pode mudar este ajuste.|Não, ninguém precisa de licença.|Nunca imprimimos sem prova.|O manual não permite outro óleo.|Não é preciso ajustar nada.|O pedido é recusado quando falta a chave.",
}
TRAINING_SHORT = "Yes.|No.|Only on request.|Yes, since version 3.|Never.|Ja.|Nein.|Nur auf Anfrage.|Ja, ab Version 3.|Oui.|Non.|Seulement sur demande.|Oui, depuis la version 3.|Sí.|No.|Solo a petición.|Sì.|Solo su richiesta.|Ja.|Nee.|Alleen op verzoek.|Ja, vanaf versie 3.|Sim.|Não.|Somente a pedido.|Sim, desde a versão 3.|Every Monday.|The operator.|Bis Freitag.|42 minutes"


def _sample(pairs: DataFrame, sample_rows: int) -> list[tuple[str, str]]:
    """At most ``sample_rows`` pairs with question and answer: those with the smallest hash."""
    rows = pairs.select("question", "answer").where("question is not null and answer is not null").orderBy(F.xxhash64("question", "answer"), "answer").limit(sample_rows).collect()
    return [(canonical_text(r[0]).strip(), canonical_text(r[1]).strip()) for r in rows if r[0].strip() and not is_empty(r[1])]


def question_languages(pairs: DataFrame, model: LanguageModel, sample_rows: int = 800) -> LanguageModel:
    """The language model, widened by questions of a bounded sample, which mostly have the language of their answer."""
    rows = _sample(pairs, sample_rows)
    scores = language_scores(model, [a for _, a in rows])
    two = np.sort(scores, axis=1)[:, -2:]
    return widen(model, [(model.names[s.argmax()], q) for (q, _), s, t in zip(rows, scores, two) if t[1] - t[0] >= 0.05])


def train(pairs: DataFrame, model: LanguageModel, sample_rows: int = 800, seed: int = 3) -> ChainField:
    """Fit the field on at most ``sample_rows`` pairs (the documented bound; those with the smallest hash)."""
    rows = _sample(pairs, sample_rows)
    rng = np.random.default_rng(seed)
    sound, seen, end = [], Counter(), Counter()
    for (q, a), (cs, _, ql, al) in zip(rows, tag_batch([(q, a, None) for q, a in rows], model, None)):
        every = [all_keys(c) for c in cs]
        for i, (e, z) in enumerate(every):
            seen.update(e)
            if i < len(cs) - 1 or is_final(cs[i]):
                end.update(z)
        asked = set(words_of(fold(q)))
        echo = all(len(asked & set(words_of(fold(c)))) > 0.6 * max(1, len(set(words_of(fold(c))))) for c in cs)
        if ql >= 0 and ql == al and _FINAL.search(a) and not echo and not any(refuses(fold(_QUOTED.sub(" ", c))) for c in cs):
            sound.append((q, a, cs, model.names[ql]))
    if not sound:
        sound = [("What is this about?", "This is a sentence.", ["This is a sentence."], "en")]
    by_lang: dict[str, list[str]] = {}
    for _, a, _, lang in sound:
        by_lang.setdefault(lang, []).append(a)
    made: list[tuple[str, str, list[int]]] = []

    def add(q: str, a: str, tag) -> None:
        cs = clauses_of(a)
        if cs:
            made.append((q, a, tag(len(cs)) if callable(tag) else [tag] * len(cs)))

    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    for q, a, cs, lang in sound:
        add(q, a, ANSWER)
        body = a.rstrip(".!? ")
        add(q, body, ANSWER)
        last = cs[-1]
        add(q, _BULLET.sub("", last, count=1).rstrip(".!? "), ANSWER)
        if len(last) > 25:
            keep = int(rng.integers(len(last) // 4, len(last) - 4))
            if rng.random() < 0.4:
                keep = last.rfind(" ", 0, keep + 1)
            part = last[:keep].rstrip()
            k1, k2 = last_keys(part)
            if len(part) > 8 and not _FINAL.search(part) and end[k2] < 0.3 * max(1, seen[k2]):
                add(q, a[: len(a) - len(last)] + part, lambda n: [ANSWER] * (n - 1) + [UNFINISHED])
                add(q, _BULLET.sub("", part, count=1), UNFINISHED)
                add(q, a[: len(a) - len(last)] + part + pick([" …", "...", "…", " ..."]), lambda n: [ANSWER] * (n - 1) + [UNFINISHED])
                add(q, f"1. {body}.\n2.", lambda n: [ANSWER] * (n - 1) + [UNFINISHED])
        core = q.rstrip("?.! ")
        ws = core.split()
        ws[int(rng.integers(len(ws)))] = pick(["the", "x", "ein", "la"])
        add(q, pick([q, core + ".", core, q.lower(), q.upper(), f'"{q}"', f"{q} {q}", " ".join(ws) + "?", "Re: " + q, f"> {q}"]), ECHO)
        add(q, f"{core.strip('¿')}? {a}", lambda n: [ECHO] + [ANSWER] * (n - 1))
        if lang in TRAINING_REFUSALS:
            no, kind = pick(TRAINING_REFUSALS[lang].split("|")), TRAINING_COURTESY[lang].split("|")
            add(q, pick([no, no.rstrip("."), no.lower(), f"{kind[0]} {no}", f"{no} {kind[1]}", f"{no} {pick(TRAINING_REFUSALS[lang].split('|'))}"]), REFUSAL)
            add(q, f"{no} {a}", lambda n: [REFUSAL] + [ANSWER] * (n - 1))
            add(q, pick(TRAINING_PLAIN[lang].split("|")), ANSWER)
            add(q, f"{pick(TRAINING_PLAIN[lang].split('|'))} {a}", ANSWER)
            far = pick(sorted(TRAINING_REFUSALS))
            add(q, pick([pick(TRAINING_REFUSALS[far].split("|")), f"{pick(TRAINING_REFUSALS[far].split('|'))} {TRAINING_COURTESY[far].split('|')[1]}"]), REFUSAL)
        add(q, pick(TRAINING_SHORT.split("|")), ANSWER)
        others = [x for x in by_lang if x != lang]
        if others:
            add(q, pick(by_lang[pick(others)]), FOREIGN)
    facts = []
    for q, a, _ in made:
        tail = clauses_of(a)[-1]
        k1, k2 = last_keys(tail)
        facts.append((q, a, None if is_final(tail) else (seen[k1] + 1, end[k1] + 1, seen[k2] + 1, end[k2] + 1)))
    data = [(x, y) for (cs, x, _, _), (_, _, y) in zip(tag_batch(facts, model, None), made) if len(cs) == len(y)]
    return ChainField.fit(data)


def find_defects(pairs: DataFrame, key: str, model: LanguageModel, field: ChainField) -> DataFrame:
    """One row (``key``, defect) per defective pair of ``pairs`` (question, answer).

    Defects, the first that holds: empty, copied, refusal, other_language, truncated.
    Pairs whose question is null or blank have no row.  Texts are read whole; equal
    pairs are judged equally.  The counts of words at clause ends come from all
    answers, combined per task before they are shuffled, and only the counts of the
    last words of answers without a final mark are joined back.
    """
    kind = pairs.schema[key].dataType.simpleString()
    src = pairs.select(F.col(f"`{key}`").alias("key"), "question", "answer").where(F.regexp_replace("question", r"(?U)[\s\p{Cf}]", "") != "")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, end = Counter(), Counter()

        def flush():
            keys = list(seen)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[k] for k in keys], pa.int64()), pa.array([end[k] for k in keys], pa.int64())], names=["k", "seen", "ended"])

        for batch in batches:
            for answer in batch.column(0).to_pylist():
                cs = clauses_of(answer) if answer else []
                for i, c in enumerate(cs):
                    e, z = all_keys(c)
                    seen.update(e)
                    if i < len(cs) - 1 or is_final(c):
                        end.update(z)
            if len(seen) > 500_000:
                yield flush()
                seen.clear()
                end.clear()
        if seen:
            yield flush()

    def open_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for key_, q, a in zip(*(c.to_pylist() for c in batch.columns)):
                cs = [] if is_empty(a) else clauses_of(a)
                k1, k2 = last_keys(cs[-1]) if cs and not is_final(cs[-1]) else (None, None)
                got.append((key_, q, a, k1, k2))
            cols = list(zip(*got)) if got else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [batch.schema.field(0).type, *[pa.string()] * 4])], names=["key", "question", "answer", "k1", "k2"])

    split = cut(src.mapInArrow(open_ends, f"key {kind}, question string, answer string, k1 string, k2 string"))
    asked = split.where("k1 is not null").select(F.explode(F.array("k1", "k2")).alias("k")).distinct()
    counts = pairs.select("answer").where("answer is not null").mapInArrow(count, "k string, seen long, ended long").groupBy("k").agg(F.sum("seen").alias("seen"), F.sum("ended").alias("ended"))
    known = cut(counts.hint("merge").join(asked.hint("merge"), "k", "left_semi"))
    one = known.select(F.col("k").alias("k1"), F.struct("seen", "ended").alias("e1"))
    two = known.select(F.col("k").alias("k2"), F.struct("seen", "ended").alias("e2"))
    null = F.lit(None).cast("struct<seen:bigint,ended:bigint>")
    columns = ["key", "question", "answer", "e1", "e2"]
    ready = split.where("k1 is null").select("key", "question", "answer", null.alias("e1"), null.alias("e2")).unionAll(split.where("k1 is not null").hint("merge").join(one.hint("merge"), "k1", "left").hint("merge").join(two.hint("merge"), "k2", "left").select(*columns))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys, qs, answers, e1, e2 = (c.to_pylist() for c in part.columns)
                found = ["empty" if is_empty(a) else None for a in answers]
                todo = [i for i, f in enumerate(found) if f is None]
                facts = [(qs[i], answers[i], tuple((e or {}).get(n) or 0 for e in (e1[i], e2[i]) for n in ("seen", "ended"))) for i in todo]
                for i, (cs, tags, ql, al) in zip(todo, tag_batch(facts, model, field)):
                    found[i] = defect_of(qs[i], cs, tags, ql, al, model.names)
                bad = [i for i, f in enumerate(found) if f]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(bad, pa.int64())), pa.array([found[i] for i in bad], pa.string())], names=["key", "defect"])

    return ready.mapInArrow(judge, f"key {kind}, defect string").withColumnRenamed("key", key)
