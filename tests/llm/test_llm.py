import random
import re

import pytest
from tests.conftest import SMALL

pytest.importorskip("lettrine.llm")

from lettrine.llm import garble, leak, mixing, people, private, replies, scans, spans  # noqa: E402
from lettrine.llm import queries as Q  # noqa: E402
from lettrine.llm.base import words  # noqa: E402

CONTACT = "struct<raw:string,name:string,address:string>"
ATT = "struct<original_name:string,is_email_body:boolean,mime_type:string,size:bigint,md5:string,extracted_text:string,extracted_text_method:string,extracted_text_truncated:boolean>"
EMAIL = f"record_id long, batch_id string, delivered_at timestamp, message_id string, subject string, expedition_date string, author {CONTACT}, targets array<{CONTACT}>, cc array<{CONTACT}>, bcc array<{CONTACT}>, attachments array<{ATT}>, text string, line_no long, value string, path string"


def att(text, body=False, name="n"):
    return (name, body, "m", 1, "x", text, None, None)


def email(n, subject=None, atts=None, author=None, targets=None, date="2024-01-01T00:00:00+00:00"):
    return (n, "b", None, f"<{n}>", subject, date, author, targets, None, [], atts, "clash", 7, "clash", "clash")


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# ------------------------------------------------------------------ 2


NAMES = private.Names(frozenset({"stephanie", "beatrice", "anthony", "robert", "helene"}))


def pii(text):
    return [(k, text[a:b]) for a, b, k in private.find(text, NAMES)]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("", []),
        ("Écrire à jean[at]boite.example ou j.d (at) x-y.test.", [("email", "jean[at]boite.example"), ("email", "j.d (at) x-y.test")]),
        ("voir pеter@exаmple.org !", [("email", "pеter@exаmple.org")]),
        ("modèle @2025 appliqué, a@b", []),
        ("Tél. zéro six trente", []),
        ("au zéro un deux trois quatre cinq six sept huit neuf.", [("phone", "zéro un deux trois quatre cinq six sept huit neuf")]),
        ("T 06 39 98 43 75, +33 (0)4 65 71 00 48; (020) 7946-0743", [("phone", "06 39 98 43 75"), ("phone", "+33 (0)4 65 71 00 48"), ("phone", "(020) 7946-0743")]),
        ("n° 1 03 10 95 350 494 99 et QQ 98 24 16 Z", [("id_number", "1 03 10 95 350 494 99"), ("id_number", "QQ 98 24 16 Z")]),
        ("La référence client est le 178 275 00 390, dossier 994-544-333, contrat 44001653377, version 3.922.747", []),
        ("demeurant 36, allée du Grand Pré, 99708 Saint-Aubry-les-Ormes, est", [("street_address", "36, allée du Grand Pré, 99708 Saint-Aubry-les-Ormes")]),
        ("living at Flat 3, 169 Low Meadow Drive, Little Bramwick, is", [("street_address", "Flat 3, 169 Low Meadow Drive, Little Bramwick")]),
        ("La rue des Merlans sera fermée", []),
        ("remise par Mme Karikaley.", [("person_name", "Karikaley")]),
        ("au nom de RALOSALLI Stéphanie.", [("person_name", "RALOSALLI Stéphanie")]),
        ("Copie adressée à stéphanie ralosalli <s@x.test>.", [("person_name", "stéphanie ralosalli"), ("email", "s@x.test")]),
        ("l'agence Béatrice Immobilier. La résidence Hélène et le square Robert-Valdoré. Margaret House and the Anthony Wing", []),
        ("Cordialement,\nStéphanie\n\nStéphanie Tamadolard", [("person_name", "Stéphanie"), ("person_name", "Stéphanie Tamadolard")]),
    ],
)
def test_pii(text, wanted):
    assert pii(text) == wanted


def test_given_names_of_a_large_archive(spark):
    names = [f"Wilfrid S{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(8)] + ["Jean Rarissime", "Paul Rarissime"]
    names += [f"U{a}{b}{c} V{c}{b}{a}" for a in "abcdefghijklmnopqrstuvwx" for b in "abcdefghijklmnopqrstuvwx" for c in "abcdefghijklmnopqrstuvwx"]
    names += [f"{g} Martin" for g in ("Anne", "Luc", "Marc", "Rose", "Yves", "Zoe")]
    df = spark.createDataFrame([email(n, author=("raw", x, f"a{n}@x.fr")) for n, x in enumerate(names)], EMAIL)
    got = private.learn_given(df)
    assert "wilfrid" in got and "martin" not in got and "rarissime" not in got


def test_contexts_of_names_are_learned(spark):
    given = ["anna", "paul", "lucie", "marc"]
    texts = [f"Bilan {n}\nLe registre fut contresigné par {given[n % 4].title()} Sur{chr(97 + n)}no hier. Vu par Anvers et Lille. Le dossier de Bruges suit." for n in range(20)]
    df = spark.createDataFrame([email(n, atts=[att(t), att(None), att("")]) for n, t in enumerate(texts)], EMAIL)
    t = private.texts_of(df, spark.createDataFrame([], "upload_id long, email_summary string, attachment_summary string"))
    names = private.learn_contexts(t, frozenset(given))
    assert private.slot("contresigné par") in names.contexts and not {private.slot(x) for x in ("vu par", "dossier de", "anvers et")} & names.contexts and names.after == {"hier"}
    found = lambda x: [x[a:b] for a, b, _ in private.find(x, names)]
    assert found("Note contresignée.\nL'acte contresigné par marc delorme hier soir, puis contresigné par Delorme Lucie.") == ["marc delorme", "Delorme Lucie"]
    assert found("L'acte vu par marc delorme hier soir") == [] and found("") == [] == found("contresigné par") and found("acte contresigné par marc delorme demain") == []
    assert private.learn_contexts(t, frozenset()).contexts == frozenset()


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("jean at firm.com", ("email", "jean at firm.com")),
        ("jean AT firm.com", ("email", "jean AT firm.com")),
        ("jean{at}firm.com", ("email", "jean{at}firm.com")),
        ("jean <at> firm{dot}com", ("email", "jean <at> firm{dot}com")),
        ("jean Arobase firm.com", ("email", "jean Arobase firm.com")),
        ("call zero, six, one, two, three, four, five, six, seven, eight.", ("phone", "zero, six, one, two, three, four, five, six, seven, eight")),
        ("call zero-six-one-two-three-four-five-six-seven-eight", ("phone", "zero-six-one-two-three-four-five-six-seven-eight")),
        ("call zéro\u00e9, x; (ZERO ſix one two three four five sıx seven eight)", ("phone", "ZERO ſix one two three four five sıx seven eight")),
    ],
)
def test_a_single_disguise_is_seen(text, wanted):
    assert wanted in pii(text)


def test_the_gate_is_no_narrower_than_the_transducer():
    rng = random.Random(11)
    bits = ["a", "@", " ", "at", " at ", "AT", "arobase", "arobaſe", "[", "]", "(", ")", "{", "}", "<", ">", "dot", "point", ".", "fr", "x", ",", "-", "one", "un", "une", "oh", "six", "Zéro", "ſıx", "deux", "\n"]
    hit = 0
    for _ in range(60_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(4, 12))) if rng.random() < 0.6 else "".join(rng.choice(bits[-9:-1]) + rng.choice([" ", ", ", "-", "."]) for _ in range(8))
        if any(p.search(text) for p in (private._AT, private._DOT, private._WORD_RUN, private._ODD)):
            hit += 1
            assert private._disguised(text), text
            private.plain(text)
    assert hit > 1000


def test_plain_form_keeps_offsets():
    text = "é​ ａ[at]b.c"
    shape, at = private.plain(text)
    assert shape == "é a@b.c" and [text[a:b] for a, b in at][3] == "[at]" and len(shape) == len(at)


def test_redaction(spark):
    rows_ = [email(1, atts=[att("T 06 39 98 43 75"), att(None), att("")]), email(2), email(3, atts=[])]
    e = spark.createDataFrame(rows_, EMAIL)
    u = spark.createDataFrame([(1, "a@b.test, a@b.test", None)], "upload_id long, email_summary string, attachment_summary string")
    t = private.texts_of(e, u)
    given = private.Names(frozenset({"x"}))
    assert rows(private.found(t, given), "origin", "row_id", "field", "kind", "pii_text") == [("dropbox_uploads", 1, "email_summary", "email", "a@b.test"), ("parsed_emails", 1, "attachments[0].extracted_text", "phone", "06 39 98 43 75")]
    assert {(r["field"], r["text"]) for r in private.without_private(t, given).collect()} == {("attachments[0].extracted_text", "T [PHONE]"), ("attachments[1].extracted_text", None), ("attachments[2].extracted_text", ""), ("email_summary", "[EMAIL], [EMAIL]"), ("attachment_summary", None)}
    assert private.found(t.limit(0), given).count() == 0 and private.learn_given(e.limit(0)) == frozenset() and private.learn_contexts(t.limit(0), frozenset()).contexts == frozenset()


# ------------------------------------------------------------------ 4


def own(text):
    gone = set(replies.not_own(text, frozenset()))
    return [x for i, x in enumerate(text.split("\n")) if x.strip() and i not in gone]


def test_own_text():
    text = "Bonjour,\n\n> 5 000 € : validation du conseil requise.\nDe : la part du comptable, rien de neuf.\n-- point 2 -- à revoir lundi.\nOn Monday the agent wrote: see annex.\n\nCordialement,\nYann\n-- \nYann Dak\nJuriste\n\nEnvoyé de mon mobile\n\nLe 3 mai 2024 à 10:45, A B\n<a@b.test> a écrit :\n> vieux\n>\n> > plus vieux\n\nRéponse au milieu.\n\n> suite\n\nCe message est confidentiel ; merci\nde le détruire.\n"
    assert own(text) == ["Bonjour,", "> 5 000 € : validation du conseil requise.", "De : la part du comptable, rien de neuf.", "-- point 2 -- à revoir lundi.", "On Monday the agent wrote: see annex.", "Cordialement,", "Yann", "Réponse au milieu."]


@pytest.mark.parametrize("block", ["-----Message d'origine-----\nDe : A B <a@b.test>\nEnvoyé : 1 mai\nÀ : C", "________________________________\n*From:* A B <a@b.test>\n*Sent:* today\n*To:* C", "Début du message réexpédié :\n\nDe : A <a@b.test>\nObjet : x", "From: A B <a@b.test>\nSent: today\nTo: C\nSubject: s"])
def test_header_blocks(block):
    assert own(f"Hello,\r\n\r\nNew text.\r\n\r\n{block}\n\nold text\n") == ["Hello,\r", "New text.\r"]


def test_blank_and_odd_bodies():
    assert replies.not_own("", frozenset()) == [] and replies.not_own("\n \n", frozenset()) == [] and replies.not_own("x" * 100_000, frozenset()) == []


def test_inherited_text_whatever_its_wrapping(spark):
    old = "The quick brown fox jumps over the lazy dog while nineteen grey herons watch from the far bank of the river."
    new = "Indeed so.\n" + old.replace("dog while", "dog\nwhile").replace("grey herons", "grey\nherons") + "\nA new line."
    a, b = ("A <a@x>", "A", "a@x"), ("B <b@x>", "B", "b@x")
    e = [email(1, "Herons", [att(old, True)], a, [b]), email(2, "RE: Herons", [att(new, True)], b, [a], "2024-01-02T00:00:00+00:00"), email(3, "RE: Herons", [att(new, True)], b, [a], "2024-01-02T00:00:00+00:00"), email(4, "Other", [att(new, True)], b, [a]), email(5, None, None), email(6, "x", [att(None, True), None])]
    df = spark.createDataFrame(e, EMAIL)
    assert rows(replies.foreign_lines(df), "record_id", "att_pos", "line_no") == [(n, 0, i) for n in (2, 3) for i in (1, 2, 3)]
    assert {r["record_id"]: r["text"] for r in replies.own_texts(df).collect()}[2] == "Indeed so.\nA new line."
    assert replies.foreign_lines(df.limit(0)).count() == 0


def test_runs_of_a_long_thread_see_all_earlier_ones(spark, monkeypatch):
    rng = random.Random(5)
    said = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(40)) for _ in range(12)]
    texts = []
    for n in range(40):
        lines = [" ".join(f"x{n}y{rng.randrange(10_000)}" for _ in range(8))]
        for _ in range(rng.randrange(3)):
            w = rng.choice(said).split()
            a = rng.randrange(20)
            lines += [" ".join(w[a : a + 10]), " ".join(w[a + 10 : a + 20])]
        texts.append("\n".join(lines))
    texts[39] = "only here\n" + said[11]  # of the first message
    texts[0] += "\n" + said[11]
    df = spark.createDataFrame([email(n, "Budget", [att(t, True)], ("raw", "A", "a@x.fr"), [("raw", "B", "b@x.fr")], f"2024-01-01T00:00:{n:02d}+00:00") for n, t in enumerate(texts)], EMAIL)
    found = {}
    for run in (3, 1000):
        monkeypatch.setattr(replies, "RUN", run)
        found[run] = rows(replies.inherited(replies.bodies(df)), "record_id", "att_pos", "line_no")
    earlier, wanted = set(), []
    for n, t in enumerate(texts):
        w = [words(x) for x in t.split("\n")]
        flat = [x for y in w for x in y]
        grams = [tuple(flat[i : i + 15]) for i in range(len(flat) - 14)]
        marks = {k for i, g in enumerate(grams) if g in earlier for k in range(i, i + 15)}
        ends = [sum(map(len, w[: i + 1])) for i in range(len(w))]
        wanted += [(n, 0, i) for i, x in enumerate(w) if all(k in marks for k in range(ends[i] - len(x), ends[i]))]
        earlier.update(grams)
    assert (39, 0, len(texts[39].split("\n")) - 1) in wanted
    assert found[3] == wanted and found[1000] == wanted


def test_endings_of_a_sender_and_of_a_firm_in_a_large_table(spark):
    def mail(n, address, ending):
        return email(n, f"s{n}", [att(f"Bonjour {n}\n\nCordialement,\nJean\n\n{ending}", True)], ("raw", "A", address), [("raw", "B", "b@x.fr")])

    own, firm = "Nous semons des arbres dans toute la France entière.", "La maison des graines vous accueille chaque jour ouvré."
    mails = [mail(n, "jean@semis.fr", own) for n in range(9)] + [mail(n, f"p{n}@Graines.fr", firm) for n in range(9, 18)]
    mails += [mail(18, "x@autre.fr", own)] + [mail(n, f"q{n}@d{n}.fr", f"Je passerai demain vers {n} heures devant la gare.") for n in range(19, 12_000)]
    got = rows(replies.foreign_lines(spark.createDataFrame(mails, EMAIL)), "record_id", "att_pos", "line_no")
    assert got == [(n, 0, 5) for n in range(18)]


def test_endings_that_recur_with_a_sender(spark):
    def mail(n, address, text):
        return email(n, f"s{n}", [att(text, True)], ("raw", "A", address), [("raw", "B", "b@x.fr")])

    sign = "Cordialement,\nJean\n\nau service des jardins et des parcs de la ville depuis cinquante ans,"
    open_end = "Le compte rendu {} est joint.\nau service des jardins et des parcs de la ville,\nouvert du lundi au jeudi,"
    mails = [mail(1, "j@a.fr", f"Un mot.\n\n{sign}\nbureau 12"), mail(2, "J@a.fr", f"Deux mots.\n\n{sign}\nbureau 14"), mail(3, "j@a.fr", f"Un mot.\n\n{sign}\nbureau 12"), mail(4, "x@b.fr", f"Un mot.\n\n{sign}"), mail(5, None, f"Un mot.\n\n{sign}")]
    mails += [mail(n, "o@c.fr", open_end.format(n)) for n in (6, 7, 8)] + [mail(9, "o@c.fr", "au service des jardins et des parcs de la ville,\nsauf demain."), mail(10, None, None), mail(11, "o@c.fr", "")]
    df = spark.createDataFrame(mails, EMAIL)
    wanted = [(n, 0, 5) for n in (1, 2, 3)] + [(n, 0, i) for n in (6, 7, 8) for i in (1, 2)]
    assert sorted(set(rows(replies.sender_endings(replies.bodies(df)), "record_id", "att_pos", "line_no"))) == wanted
    assert set(wanted) <= set(rows(replies.foreign_lines(df), "record_id", "att_pos", "line_no"))
    assert replies.sender_endings(replies.bodies(df.limit(0))).count() == 0


def test_word_automaton_against_brute_force():
    r = random.Random(3)
    for _ in range(60):
        texts = [[r.choice("ab") for _ in range(r.randint(0, 12))] for _ in range(3)]
        ask = [r.choice("abc") for _ in range(15)]
        a = replies.WordAutomaton()
        for t in texts:
            a.add(t)
        wanted = [False] * 15
        for i in range(15):
            for j in range(i + 3, 16):
                if any(ask[i:j] == t[k : k + j - i] for t in texts for k in range(len(t))):
                    wanted[i:j] = [True] * (j - i)
        assert a.inherited(ask, 3) == wanted


# ------------------------------------------------------------------ 5


PAGES = "MITEGO ASSURANCES\nLe syndic confirme le contrat de main-\ntenance pour un montant de 12 € et le\nreste suit sans autre\n\n- 1 -\nMITEGO ASSURANCES\ndélai avant le rendez-\nvous de chantier prévu demain matin.\n\n- 2 -\nM1TEGO ASSURANCES\n\nRéférence VN-\n84576 jointe au gesti0nnaire.\n\n- 3 -"


def test_scan_lines(spark):
    filler = "maintenance rendez-vous gestionnaire " * 30
    e = spark.createDataFrame([email(1, atts=[att(PAGES), att(PAGES, True), None, att("")]), email(2, atts=[att(filler)]), email(3)], EMAIL)
    got = rows(scans.line_kinds(e), "record_id", "att_pos", "line_no", "kind")
    assert got == [(1, 0, 0, "running"), (1, 0, 1, "hyphen"), (1, 0, 5, "page_number"), (1, 0, 6, "running"), (1, 0, 10, "page_number"), (1, 0, 11, "running"), (1, 0, 14, "misread"), (1, 0, 16, "page_number")]
    text = {r["record_id"]: r["text"] for r in scans.repaired_texts(e).where("att_pos = 0").collect()}[1]
    assert "contrat de maintenance pour" in text and "sans autre délai avant le rendez-vous de chantier" in text and "VN-84576 jointe au gestionnaire." in text and "MITEGO" not in text and "- 1 -" not in text
    assert scans.line_kinds(e.limit(0)).count() == 0


def test_blocks_of_the_forms_change_nothing(spark, monkeypatch):
    e = spark.read.parquet(f"{SMALL}/parsed_emails.parquet")
    kinds = rows(scans.line_kinds(e), "record_id", "att_pos", "line_no", "kind")
    texts = rows(scans.repaired_texts(e), "record_id", "att_pos", "text")
    n = scans.learned(scans.scanned(e)).count()
    assert n > 10
    for block in (-(-n // 12), -(-n // 2)):
        monkeypatch.setattr(scans, "BLOCK", block)
        assert rows(scans.line_kinds(e), "record_id", "att_pos", "line_no", "kind") == kinds
        assert rows(scans.repaired_texts(e), "record_id", "att_pos", "text") == texts


def test_split_words_are_mended_whole():
    r = scans.Repairer([("copie5", "", 5, "copies"), ("pos", "sib1e", 6, "possible"), ("rendez", "v0us", 7, "rendez-vous"), ("rendez", "vous", None, None), ("rendez", "v0us", None, None)])
    assert r.repaired("deux copie5.\nIl est Pos-\nsib1e, au rendez-\nv0us de mardi") == "deux copies. Il est Possible, au rendez-vous de mardi"
    assert scans.Repairer([]).repaired("") == "" and scans.Repairer([]).repaired("a-\n\n") == "a-"


def test_running_lines_of_any_length():
    head = "Cabinet " + "de Monsieur et Madame " * 12 + "Notaires"
    lines = f"{head}\nLe contrat est\n\n{head}   12\nprolongé d'un an\n\n{head.replace('Madame', 'Madarne', 1)}\net le reste suit".split("\n")
    assert scans.furniture(lines) == {0: "running", 3: "running", 6: "running"}


# ------------------------------------------------------------------ 6


def test_garbled(spark):
    clean = ["Frédéric Ménard", "Réception de chantier", "Élisabeth Noël", "Été à Orléans", "Âge du bâtiment", "Счёт за март", "Łąkowa", "Décompte détaillé"]
    values = [f"{v} {i}" for i in range(40) for v in clean]
    bad = {"FrÃ©dÃ©ric Lamy": "Frédéric Lamy", "R√©ception de chantier": "Réception de chantier", "Fr├®d├®ric Roy": "Frédéric Roy", "FrÃƒÂ©dÃƒÂ©ric Roux": "Frédéric Roux", "FrÚdÚric Petit": "Frédéric Petit"}
    e = [email(i, v) for i, v in enumerate([*values, *bad, "R�ception", "", None])]
    df = spark.createDataFrame(e, EMAIL)
    got = {r["value"]: r["restored"] for r in garble.judge(df).collect()}
    assert got == bad | {"R�ception": None}
    assert {r["field_path"] for r in garble.judge(df).collect()} == {"subject"} and garble.judge(df.limit(0)).count() == 0


def test_margin_by_all_values(spark):
    import numpy as np

    r = random.Random(4)
    clean = ["".join(r.choice("abc éèà çô") for _ in range(12)) for _ in range(300)]
    model = garble.Model(garble.counts(clean), garble.CLEANING)
    df = spark.createDataFrame([(t,) for t in [*clean, None, "", "ascii"]], "value string")
    kept = [t for t, (bad, *_) in zip(clean, model.judged(clean), strict=True) if not bad and not t.isascii()]
    good = np.array([g for *_, g in model.judged(kept)])
    bad = np.array([g for *_, g in model.judged([b for t in kept for b in garble._garbled_on_purpose(t)])])
    loss = np.array([30 * (good > m).mean() + (bad <= m).mean() for m in garble.GRID])
    best = garble.GRID[loss <= loss.min() + 1e-9]
    assert abs(garble.validated_margin(df.repartition(3), model) - (best[0] + best[-1]) / 2) < 1.01
    assert garble.validated_margin(df.limit(0), model) == 5.0
    table = garble.gain_counts(model, {t: 1 for t in kept})
    assert table[0].sum() == len(kept) and table[1].sum() == len(bad) and garble.margin_of(table) == (best[0] + best[-1]) / 2


def test_chains_of_several_steps():
    for wrongs in (("cp1252", "cp1252", "cp1252"), ("mac_roman", "cp1252", "cp1252"), ("cp1252", "latin-1")):
        seen = "Réunion à Orléans"
        for wrong in wrongs:
            seen = garble.from_bytes(seen.encode(), wrong)
        chain = garble.undone(seen)["Réunion à Orléans"]
        assert chain.count(",") == len(wrongs) - 1 and garble.restored(seen, chain) == "Réunion à Orléans"


def test_chains_undo_what_was_done():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choice("aéèÉç °–🔴") for _ in range(8))
        for wrong in ("cp1252", "mac_roman", "cp850"):
            seen = garble.from_bytes(text.encode(), wrong)
            if not text.isascii():
                assert text in garble.undone(seen)


# ------------------------------------------------------------------ 7


def test_radius_join_against_brute_force(spark):
    r = random.Random(5)
    names = list(dict.fromkeys("".join(r.choice("abcd") for _ in range(r.randint(1, 7))) for _ in range(160)))
    rows_ = lambda some, other: spark.createDataFrame([("x", n, 1) for n in some] + [("y", n, 1) for n in some[:20]] + [("x", None, 1), (None, "a", 1), (other, "abc", 1)], "block string, value string, cell int")
    left, right = rows_(names[:90], "l"), rows_(names[60:], "r")
    wanted = {("x", a, b, people._edit(a, b)) for a in names[:90] for b in names[60:]} | {("y", a, b, people._edit(a, b)) for a in names[:20] for b in names[60:80]}
    for radius, cell, pivots in ((2, 1000, 16), (2, 10, 3), (1, 5, 4), (2, 1, 2)):
        got = people.radius_join(left, right, radius, cell, pivots).collect()
        assert len(got) == len(set(got)) and {tuple(x) for x in got} == {x for x in wanted if x[3] <= radius}, (radius, cell)
    assert people.radius_join(left.limit(0), right).count() == people.radius_join(left, right.limit(0)).count() == 0


def test_slip_join_against_brute_force(spark):
    r = random.Random(6)
    names = list(dict.fromkeys("".join(r.choice("abc") for _ in range(r.randint(0, 7))) for _ in range(160)))
    side = lambda some: spark.createDataFrame([("x", n) for n in some], "block string, value string")
    wanted = {("x", a, b, people._edit(a, b)) for a in names[:100] for b in names[50:] if a == b or people.damerau_is_one(a, b)}
    for cell in (1000, 10):
        got = people.slip_join(side(names[:100]), side(names[50:]), cell, 4).collect()
        assert len(got) == len(set(got)) and {tuple(x) for x in got} == wanted
    assert people.slip_join(side(["a"]).limit(0), side(["a"])).count() == 0


def test_names_meet_in_the_radius_join_only(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/header_contacts.parquet")
    whole = people.linked_pairs(df).count()
    real = people.radius_join
    monkeypatch.setattr(people, "radius_join", lambda left, right: real(left, right.limit(0)))
    monkeypatch.setattr(people, "slip_join", lambda left, right: real(left, right.limit(0)))
    assert people.linked_pairs(df).count() < 0.1 * whole


def test_cells_split_while_overfull_change_nothing(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/header_contacts.parquet")
    once = rows(people.link(df), "contact_id", "entity")
    monkeypatch.setattr(people, "CELL", 5)
    monkeypatch.setattr(people, "HALVED_CELL", 40)
    assert rows(people.link(df), "contact_id", "entity") == once


def test_links(spark):
    given = ["anna", "paul", "marc", "lise", "jean"]
    rows_, n = [], 0
    for o in range(12):
        for g in given:
            n += 1
            rows_.append((n, f"{g.title()} Sur{chr(97 + o)}nam", f"{g}.sur{chr(97 + o)}nam@org{chr(97 + o)}.test"))
        n += 1
        rows_.append((n, f"Org{chr(97 + o)} Conseil SARL", f"contact@org{chr(97 + o)}.test"))
    more = [(1001, "SURANAM Anna", "asuranam@orga.test"), (1002, "A. Suranam", "a.suranam@mail.orga.test"), (1003, None, "anna.suranam@orga.test"), (1004, "Anna Suranma", None), (1005, "Orga Conseil", None), (1006, None, None), (1007, "Anna Suranam", "ANNA.SURANAM@ORGA.TEST"), (1007, "Anna Suranam", "ANNA.SURANAM@ORGA.TEST"), (1008, "", ""), (1009, "Anna Lonesome", None), (1010, "Anna LONESOME", None), (1011, "Lonesmoe, Anna", None), (1012, "A. Suranma", None), (1013, "Suranm", None)]
    df = spark.createDataFrame([(i, "raw", a, b, "x") for i, a, b in rows_ + more], "contact_id long, raw string, name string, address string, entity string")
    pairs = set(rows(people.linked_pairs(df), "contact_id_a", "contact_id_b"))
    anna, firm, loose = [1, 1001, 1002, 1003, 1004, 1007, 1012], [6, 1005], [1009, 1010, 1011]
    assert pairs == {(a, b) for group in (anna, firm, loose) for a in group for b in group if a < b}
    assert people.linked_pairs(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 8


DOCS = "doc_id long, text string, source string, item_id long"


def grams(text, n):
    w = words(text or "")
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_leaks_against_brute_force(spark):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(20)), "x") for i in range(20)] + [(50, None, "x"), (51, "short", "x")]
    docs = [(i, "Début. " + " ".join(r.choice(vocabulary) for _ in range(10)) + " " + items[i % 20][1].upper().replace(" ", ", ", 3), "s", 1) for i in range(40)] + [(90, None, "s", 1), (91, "", "s", 1)]
    d, e = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string, doc_id string")
    wanted = {(a[0], b[0]) for a in docs for b in items if grams(a[1], 6) & grams(b[1], 6)}
    assert set(rows(leak.leaks(d, e, 6), "doc_id", "item_id")) == set(rows(leak.leaks(d, e, 6, block_chars=200), "doc_id", "item_id")) == wanted
    assert leak.leaks(d.limit(0), e).count() == leak.leaks(d, e.limit(0)).count() == 0
    before = {x[0]: x[1] for x in docs}
    clean = {r["doc_id"]: r for r in leak.without_leaks(d, e, 6, 6, 1.0).collect()}
    assert set(clean) == set(before) and clean[90]["text"] is None and clean[91]["text"] == ""
    for i, t in before.items():
        w, inside = words(t or ""), set()
        for k in range(len(w) - 5):
            if any(tuple(w[k : k + 6]) in grams(x[1], 6) for x in items):
                inside.update(range(k, k + 6))
        assert clean[i]["removed_words"] == len(inside) and words(clean[i]["text"] or "") == [x for k, x in enumerate(w) if k not in inside]


def test_cut_spans_keep_the_rest(spark):
    item = "the letter of the seventh of june says that nobody pays for the broken gate at all"
    d = spark.createDataFrame([(1, f"Before this: {item.title()}, after.", "s", 1), (2, item, "s", 1)], DOCS)
    e = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in leak.without_leaks(d, e, max_coverage=0.9).collect()}
    assert got == {1: "Before this: , after.", 2: ""}


def test_blocks_of_items_do_not_show_in_the_cut(spark):
    one, two = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my", "one two three four five six seven eight nine ten eleven twelve thirteen"
    d = spark.createDataFrame([(1, f"{one}. Own words stand in the middle of it here, as they should. {two}", "s", 1), (2, f"{two} and more words of its own, so that nothing is emptied here at all", "s", 1), (3, None, "s", 1), (2, "another text under the same id", "s", 1)], DOCS)
    e = spark.createDataFrame([(1, one), (2, two), (3, "never seen anywhere in these documents, whatever one may look for")], "item_id long, text string")
    for coverage in (0.5, 0.9):
        whole = sorted(map(tuple, leak.without_leaks(d, e, max_coverage=coverage).collect()), key=str)
        for size in (1, 80):
            assert sorted(map(tuple, leak.without_leaks(d, e, max_coverage=coverage, block_chars=size).collect()), key=str) == whole
    assert {r["doc_id"]: r["text"] for r in leak.without_leaks(d, e).where("removed_words > 0").collect()}[1] == ""


# ------------------------------------------------------------------ 9


def test_mixing(spark):
    docs = [(i, "word " * (i % 7 + 1), "big" if i % 10 else "small", 1) for i in range(2000)] + [(5000, "x", None, 1), (5001, None, "big", 1), (5002, "", "small", 1), (5003, "y", "unlisted", 1)]
    d = spark.createDataFrame(docs, DOCS)
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeat int")
    chosen, shares = mixing.mixed(d, t)
    s = {r["source"]: r for r in shares.collect()}
    assert s["none"]["actual_share"] == 0 and abs(s["big"]["actual_share"] - 5 / 9) < 0.02 and all(r["most_uses"] <= r["max_repeat"] for r in s.values())
    used = chosen.collect()
    assert len({r["doc_id"] for r in used}) == len(used) and {r["source"] for r in used} == {"big", "small"}
    assert rows(chosen, "doc_id", "uses") == rows(mixing.mixed(d, t)[0], "doc_id", "uses")
    short = {r["source"]: r for r in mixing.mixed(d, t, total_tokens=1e6)[1].collect()}
    assert short["small"]["most_uses"] == 3 and short["small"]["rate"] == 3 and short["small"]["short_tokens"] > 0
    assert mixing.mixed(d.limit(0), t)[0].count() == 0 and mixing.mixed(d, t.limit(0))[0].count() == 0


def test_tokens(spark):
    import tiktoken

    assert isinstance(mixing._encoder(mixing.TOKENIZER), tiktoken.Encoding)
    assert [r["n_tokens"] for r in mixing.with_tokens(spark.createDataFrame([(1, "hello world", "s", 1), (2, "<|endoftext|>", "s", 1)], DOCS)).orderBy("doc_id").collect()] == [2, 7]


# ------------------------------------------------------------------ 10


def _shared_docs():
    r = random.Random(7)
    fresh = lambda n: "".join(r.choice("abcdefgh 🔴é") for _ in range(n))
    long, edge, short = fresh(900), fresh(400), fresh(399)
    docs = [fresh(500) + long + fresh(300), long + fresh(700), fresh(50) + edge + fresh(600), fresh(700) + edge, fresh(600) + short + fresh(20), short + fresh(900), fresh(450)]
    docs += [docs[6], docs[1], "x" * 1200, "x" * 900 + "y" * 300, None, "", "z" * 399, "z" * 399]
    return [(i, t, "s", 1) for i, t in enumerate(docs)]


def _brute_pairs(docs):
    w = {i: {t[k : k + 400] for k in range(len(t) - 399)} for i, t, *_ in docs if t}
    return {(a, b) for a in w for b in w if a < b and w[a] & w[b]}


@pytest.mark.parametrize("many", [0, 1, 48])
def test_shared_spans_against_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(spans, "MANY", many)
    docs = _shared_docs()
    df = spark.createDataFrame(docs, DOCS)
    s = spans.SharedSpans(df)
    assert set(rows(s.document_pairs(), "doc_id_a", "doc_id_b")) == _brute_pairs(docs)
    text = {i: t for i, t, *_ in docs}
    found = s.maximal().collect()
    reps = {r["rep"] for r in s.members.collect()}
    holders = {}
    for r in found:
        assert r["chars"] >= 400 and text[r["rep"]][r["start"] : r["start"] + r["chars"]] == text[r["span_rep"]][r["span_start"] : r["span_start"] + r["chars"]]
        holders.setdefault((r["span_rep"], r["span_start"], r["chars"]), set()).add((r["rep"], r["start"]))
        assert len({x for x, _ in holders[r["span_rep"], r["span_start"], r["chars"]]}) <= r["texts"]
    assert all(len({x for x, _ in h}) > 1 and min(h) == k[:2] for k, h in holders.items())
    # each window that two texts share lies in one span of both, at the same place of it, and in no other
    where = {}
    for i in reps:
        for k in range(len(text[i]) - 399):
            where.setdefault(text[i][k : k + 400], set()).add((i, k))
    wanted = {(x, y) for h in where.values() if len({i for i, _ in h}) > 1 for x in h for y in h}
    got = [((a, p + k), (b, q + k)) for (_, _, n), h in holders.items() for a, p in h for b, q in h for k in range(n - 399)]
    assert set(got) == wanted and len(got) == len(wanted)
    assert max(r["chars"] for r in found if r["span_rep"] == 0) >= 900
    shared = {r["doc_id"]: r["shared_chars"] for r in s.shared_chars(df).collect()}
    for i, t, *_ in docs:
        others = {u[k : k + 400] for j, u, *_ in docs if j != i and u for k in range(len(u) - 399)}
        inside = [False] * len(t or "")
        for k in range(len(t or "") - 399):
            if t[k : k + 400] in others:
                inside[k : k + 400] = [True] * 400
        assert shared[i] == sum(inside), i


def test_shared_spans_of_nothing(spark):
    assert spans.SharedSpans(spark.createDataFrame([], DOCS)).document_pairs().count() == 0


# ------------------------------------------------------------------ very long texts


@pytest.mark.parametrize("text", ["12 rue " + "a" * 50_000, "12 rue " + "de la " * 20_000, "A" * 100_000, "Le mot suit\n" * 4_000, "Anna Bell\n" * 4_000, " " * 100_000 + "x", "> " * 50_000, "-" * 100_000, "a" + " " * 100_000 + "b", "un deux " * 10_000, "a@" * 20_000, "1 " * 50_000, "mot- \n" * 5_000, "(at) " * 10_000])
def test_very_long_texts(text):
    import time

    began = time.time()
    private.find(text, NAMES)
    replies.not_own(text, frozenset())
    scans.Repairer([]).kinds(text)
    scans.Repairer([]).repaired(text)
    garble.Model(garble.counts([text])).judged([text])
    assert time.time() - began < 20


# ------------------------------------------------------------------ queries


def test_queries_have_the_columns_asked_for(spark):
    wanted = {
        "p2_found": ["origin", "row_id", "field", "kind", "pii_text"], "p4_found": ["record_id", "att_pos", "line_no"], "p5_found": ["record_id", "att_pos", "line_no", "kind"], "p6_found": ["record_id", "field_path"],
        "p7_found": ["contact_id_a", "contact_id_b"], "p8_found": ["doc_id", "item_id"], "p10_found": ["doc_id_a", "doc_id_b"],
    }
    for name, columns in wanted.items():
        df = Q.queries()[name](spark, SMALL)
        assert df.columns == columns and all(t in ("bigint", "string") for _, t in df.dtypes)
        assert df.count() == df.distinct().count() > 0, name
    assert all(re.fullmatch(r"p\d+_\w+", n) for n in Q.queries())
