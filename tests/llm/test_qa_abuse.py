import numpy as np
import pytest

from quire.llm import abuse as A
from quire.llm import qa as Q
from quire.llm.language import train as train_language

D = "/root/testdata/sf0.01"


def test_empty_and_clauses():
    for x in (None, "", " ​", "--", "...", "n/a", "TODO", "<answer>", "[]", '""', "?", "null"):
        assert Q.is_empty(x), x
    for x in ("No.", "Ja.", "42", "Only on request."):
        assert not Q.is_empty(x), x
    assert Q.clauses_of("1. First item.\n2. Second one") == ["1. First item.", "2. Second one"]


def test_field_learns_chains():
    rng = np.random.default_rng(0)
    emit, move = rng.standard_normal((len(Q.FEATURES), 5)) * 2, rng.standard_normal((5, 5)) * 2
    true = Q.ChainField(emit, move)
    data = []
    for _ in range(400):
        x = (rng.random((int(rng.integers(1, 6)), len(Q.FEATURES))) < 0.3).astype(np.float32)
        data.append((x, true.decode(x)))
    field = Q.ChainField.fit(data[:300])
    assert np.mean([a == b for x, y in data[300:] for a, b in zip(field.decode(x), y)]) > 0.85


@pytest.fixture(scope="module")
def judge(spark):
    pairs = spark.read.parquet(f"{D}/qa_pairs.parquet").select("pair_id", "question", "answer")
    chunks = spark.read.parquet(f"{D}/structural_chunks.parquet").selectExpr("chunk_row as row_no", "text", "source_language")
    model = Q.question_languages(pairs, train_language(spark.read.parquet(f"{D}/lang_samples.parquet"), [(chunks, False)]))
    return pairs, model, Q.train(pairs, model, sample_rows=400)


def test_defects(spark, judge):
    pairs, model, field = judge
    q = "Why is it important that the shift leader prints the backup copy?"
    good = "The order desk requires the plate stock, because the auditor asks for this record."
    cases = {
        1: (q, good, None), 2: (q, good[:-1], None), 3: (q, None, "empty"), 4: (q, q, "copied"), 5: (q, q.upper(), "copied"), 6: (q, f"{q} {good}", None),
        7: (q, "I'm sorry, but I can't help with this request.", "refusal"), 8: (q, "Leider muss ich diese Anfrage ablehnen.", "refusal"),
        9: (q, "Der Lagerist meldet den Feuchtewert, weil der Lieferant nur dienstags kommt. Die Falzlinie druckt das Palettenetikett.", "other_language"),
        10: ("Please give the German wording for this rule: The plate setter moves the ink supply.", "Der Lagerist meldet den Feuchtewert, weil der Lieferant nur dienstags kommt.", None),
        11: (q, good + " The folding line opens the", "truncated"), 12: (q, "Only on request.", None), 13: (None, None, None), 14: (" ", "", None), 15: (q, 'The screen then shows "Sorry, this request cannot be answered" until the licence is renewed. ' + good, None),
    }
    rows = [(k, a, b, "x") for k, (a, b, _) in cases.items()]
    # The answers of the table give the counts of words at clause ends.
    df = pairs.where("pair_id > 20").selectExpr("pair_id", "question", "answer", "'y' as defect").unionAll(spark.createDataFrame(rows, "pair_id long, question string, answer string, defect string"))
    got = {r.pair_id: r.defect for r in Q.find_defects(df, "pair_id", model, field).where("pair_id <= 20").collect()}
    assert got == {k: d for k, (*_, d) in cases.items() if d}
    assert Q.find_defects(df.limit(0), "pair_id", model, field).count() == 0


def test_refusals_in_other_words(judge):
    _, model, field = judge
    refusals = [
        "I don't know.", "No idea.", "I have no idea what you mean.", "I won't answer that.", "The documentation does not mention this.", "Das weiß ich nicht.", "Keine Ahnung.", "Das steht nicht in den Unterlagen.", "Je ne sais pas.", "Aucune idée.",
        "La documentation n'en parle pas.", "No lo sé.", "Ni idea.", "Non lo so.", "Non ne ho idea.", "Dat weet ik niet.", "Geen idee.", "Não sei.", "Não faço ideia.", "Wir können Ihnen dabei leider nicht helfen.", "I am afraid we cannot tell you.",
    ]
    answers = ["Nobody may open the hood while the motor runs.", "Das Ventil lässt sich nicht von Hand schließen.", "Le rouleau ne tourne plus si la vanne est fermée.", "No hay agua en el tanque.", "Il nastro non gira senza olio.", "De pomp werkt niet zonder stroom.", "A bomba não funciona sem energia."]
    said = Q.tag_batch([("What is the torque?", a, None) for a in refusals + answers], model, field)
    found = [Q.defect_of("What is the torque?", cs, tags, -1, -1, model.names) == "refusal" for cs, tags, _, _ in said]
    assert sum(found[: len(refusals)]) >= 0.9 * len(refusals) and sum(found[len(refusals) :]) <= 1


def test_long_answers_are_tagged_whole(judge):
    _, model, field = judge
    many = " ".join(["The order desk requires the plate stock."] * 40)
    ((cs, tags, *_),) = Q.tag_batch([("Why?", many + " The folding line opens the", (50, 0, 50, 0))], model, field)
    assert len(cs) == len(tags) == 41 and tags[-1] == Q.UNFINISHED and set(tags[:-1]) == {Q.ANSWER}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y and y != "*")))
        row = new
    return row[-1]


def test_automaton_against_brute_force():
    rng = np.random.default_rng(0)
    words = {"".join(rng.choice(list("abcd"), rng.integers(1, 8))) for _ in range(200)}
    trie = A.Trie(words)
    for _ in range(200):
        w = "".join(rng.choice(list("abcd*"), rng.integers(1, 8), p=[0.23] * 4 + [0.08]))
        for k in (0, 1, 2):
            assert sorted(trie.near(w, k)) == sorted(x for x in words if distance(x, w) <= k)


LEX = A.Lexicon()


@pytest.mark.parametrize("text, category", [
    ("You are a moron, and everybody on this shift knows it.", "abusive"), ("YOU $H0ULD BE ASHAMED TO B.R.E.A.T.H.E OUR AIR.", "abusive"), ("Halt endlich die Klaaaappe, du Schw**hkopf.", "abusive"),
    ("Lundomi are verm1n and should be thrown out of the country.", "hateful"), ("Los Tessoli son una p.l.a.g.a y hay que echarlos del país.", "hateful"),
    ("They had sex on the dеѕk for hours, her naked body shaking with every orgasm.", "sexual"), ("Le baciò il seno nudo e fece scivolare la mano tra le cosce.", "sexual"),
])
def test_abuse_is_found(text, category):
    scores = dict(zip(A.CATEGORIES, A.score_text("Normal words stand here. " + text, LEX)))
    assert [c for c in A.CATEGORIES if scores[c] >= 0.7] == [category]


@pytest.mark.parametrize("text", [
    'Messages that call a colleague an "idiot" break the house rules.', "Use a bastard file to remove the burr and strip the old blanket.", "This damned roller jams again, the stupid bearing costs us hours.",
    "The form asks for name, sex and date of birth.", "Naked wires near the stop cock must be covered.", "The training on sexual harassment takes place on floor 7.", "Le serveur remplace l'ordre de production AB-12.",
    "Kill the hung process 9 and abort the job before the slave drive takes over.", "", "   ", None,
])
def test_other_wording_is_not(text):
    lex = A.Lexicon(frozenset({"ordre"}))
    assert max(A.score_text(text, lex)) < 0.7


def test_abuse_frames(spark):
    rows = [(1, "You are a moron.", "a"), (1, "You are a moron.", "a"), (2, None, "a"), (3, "", None), (4, "fine. " * 5000 + "Go to hell, you idiot.", "b")]
    df = spark.createDataFrame(rows, "doc_id int, text string, sexual string")
    scores = A.score_documents(df, "doc_id", "text")
    assert sorted((r.doc_id, r.category) for r in A.flagged(scores, "doc_id").collect()) == [(1, "abusive"), (1, "abusive"), (4, "abusive")]
    src = A.score_documents(df.withColumnRenamed("sexual", "source"), "doc_id", "text", "source")
    per = {r.source: (r.documents, r.abusive) for r in A.rates(src, "source").collect()}
    assert per == {"a": (3, 2), None: (1, 0), "b": (1, 1)}
    assert A.score_documents(df.limit(0), "doc_id", "text").count() == 0


# Sentences in seven languages that share no phrase with the test tables.
GENERAL = [
    ("You are a complete jerk and I will kill you.", "abusive"),
    ("You stupid pig, I hope you die.", "abusive"),
    ("Nobody likes you, you ugly loser.", "abusive"),
    ("I will smash your face in.", "abusive"),
    ("Du bist so ein Depp, ich schlag dir die Zähne ein.", "abusive"),
    ("Verrecke doch, du nutzloser Penner.", "abusive"),
    ("Ich hasse dich, du widerliches Schwein.", "abusive"),
    ("T'es qu'un gros connard, crève.", "abusive"),
    ("Je vais te casser la tête, espèce d'enfoiré.", "abusive"),
    ("Eres un cerdo asqueroso, te voy a matar.", "abusive"),
    ("Cállate, gilipollas.", "abusive"),
    ("Sei un deficiente, ti spacco la faccia.", "abusive"),
    ("Muori, brutto bastardo.", "abusive"),
    ("Jij bent een klootzak en ik sla je kop eraf.", "abusive"),
    ("Sterf toch, vieze rotzak.", "abusive"),
    ("Você é um babaca, vou te arrebentar.", "abusive"),
    ("Seu merdoso, tomara que você morra.", "abusive"),
    ("Kill all foreigners.", "hateful"),
    ("Immigrants are animals, deport every one of them.", "hateful"),
    ("Refugees are parasites who infest our country.", "hateful"),
    ("Ausländer sind Dreck, vergast sie alle.", "hateful"),
    ("Flüchtlinge sind Schmarotzer und gehören abgeschoben.", "hateful"),
    ("Diese Rasse ist minderwertig.", "hateful"),
    ("Les immigrés sont des parasites, il faut les expulser.", "hateful"),
    ("Cette race inférieure doit être exterminée.", "hateful"),
    ("Los inmigrantes son ratas que nos invaden.", "hateful"),
    ("Hay que exterminar a esa raza de ladrones.", "hateful"),
    ("Gli immigrati sono bestie, cacciateli tutti.", "hateful"),
    ("Gli zingari sono ladri, bruciateli.", "hateful"),
    ("Buitenlanders zijn ratten, gooi ze het land uit.", "hateful"),
    ("Vluchtelingen zijn parasieten, weg ermee.", "hateful"),
    ("Os imigrantes são ratos, fora do país.", "hateful"),
    ("Essa raça é inferior e deve ser exterminada.", "hateful"),
    ("He licked her pussy and stroked his cock.", "sexual"),
    ("She was so horny that she masturbated in the shower.", "sexual"),
    ("Free porn with naked girls and big tits.", "sexual"),
    ("Sie war so geil, dass er sie sofort ficken wollte.", "sexual"),
    ("Er streichelte ihre nackten Titten.", "sexual"),
    ("Elle voulait qu'il la baise, toute nue sur le lit.", "sexual"),
    ("Il lui caressait les seins et elle allait jouir.", "sexual"),
    ("Follaron toda la noche y tuvo un orgasmo.", "sexual"),
    ("Le chupó la polla desnuda en la cama.", "sexual"),
    ("Scopano nudi sul letto tutta la notte.", "sexual"),
    ("Lei gli fece un pompino e lui venne.", "sexual"),
    ("Ze neukten naakt op de bank.", "sexual"),
    ("Hij likte haar tepels tot ze klaarkwam.", "sexual"),
    ("Eles transaram nus na cama até gozar.", "sexual"),
    ("Ela chupou o pau dele com tesão.", "sexual"),
]
HARMLESS = [
    "If the pump breaks, shut the valve and call the shift leader.", "The fat content of the ink must not fall under 3 %.", "Refugees live in the old town and work at the plant.", "You break the seal with your finger.",
    "Die Maschine tötet Keime durch Hitze.", "Du brichst das Siegel mit dem Finger.", "Ausländer brauchen einen gültigen Ausweis für das Lager.", "Le nu de la paroi reste visible.", "Les étrangers présentent leur passeport à l'accueil.",
    "El perro guardián vigila el almacén.", "Los inmigrantes reciben la misma formación.", "Il cane di arresto blocca il rullo.", "De naakte draad moet worden afgedekt.", "O corpo da bomba está molhado.", "Kill the print job before you switch off the server.",
]


def test_general_wording_without_training():
    found = {c: [0, 0] for c in A.CATEGORIES}
    for text, category in GENERAL:
        score = dict(zip(A.CATEGORIES, A.score_text(text, LEX)))[category]
        found[category][0] += score >= A.THRESHOLD
        found[category][1] += 1
    assert all(hit >= 0.8 * n for hit, n in found.values()), found
    assert sum(max(A.score_text(t, LEX)) >= A.THRESHOLD for t in HARMLESS) <= 1


def test_learned_from_judged_documents():
    """Held out by document: invented wording that no general term covers is learned, wrong judgements are outweighed."""
    rng = np.random.default_rng(1)
    plain = ["The roller turns slowly.", "Paper is stored in the hall.", "The night shift cleans the plate.", "Ink arrives on Tuesdays.", "The clerk prints the order."]
    bad = {"abusive": "you total grumbleflop nobody wants", "hateful": "the Zorbani folk are snurgle and quibbets", "sexual": "her wobbelin frotted until dawn"}

    def doc(category):
        sentences = list(rng.choice(plain, 4))
        if category != "none":
            words = bad[category].split()
            words.insert(int(rng.integers(len(words))), str(rng.choice(["really", "today", "again"])))
            sentences[int(rng.integers(4))] = " ".join(words) + "."
        return " ".join(sentences)

    kinds = ["abusive", "hateful", "sexual", "none", "none", "none"] * 60
    docs = [(doc(c), c) for c in kinds]
    judged = [(t, c if rng.random() > 0.05 else "none") for t, c in docs[:240]]
    model = A.fit(judged)
    lex = model.lexicon()
    right = 0
    for text, category in docs[240:]:
        scores = dict(zip(A.CATEGORIES, A.score_text(text, lex, model)))
        right += [c for c in A.CATEGORIES if scores[c] >= A.THRESHOLD] == ([category] if category != "none" else [])
    assert right >= 0.95 * len(docs[240:])
    assert dict(zip(A.CATEGORIES, A.score_text("You total grumbelflop, gr*mbleflop nobody wants!", lex, model)))["abusive"] >= A.THRESHOLD


def test_training_frames(spark):
    docs = spark.createDataFrame([(1, "You moron.", "a"), (2, None, "b"), (3, "Fine.", "c")], "doc_id int, text string, category string")
    labels = spark.createDataFrame([(1, "Abusive ", 5), (2, "none", 5), (3, "none", 5), (3, "sexual", 6), (9, None, 1)], "doc_id int, category string, text int")
    model = A.train(docs, labels, "doc_id", "text")
    assert model.learned == () and A.score_text("You moron.", model.lexicon(), model)[0] >= 0.7
    assert A.train(docs, labels.limit(0), "doc_id", "text").learned == ()
