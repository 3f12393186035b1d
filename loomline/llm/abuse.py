"""Abusive, hateful and sexually explicit language, by a weighted finite-state grammar.

Transducers are composed one after another:

* characters to plain words: invisible characters, look-alike letters, figures for letters, spaced or stretched letters and masks (``s**m``)
  are undone, the last three only where a word of the lexicon comes out;
* words to classes: target, insult, insulting adjective, dehumanising noun, violent verb, people, expulsion, reported speech and so on, one
  symbol each;
* negation: reads the classes and marks what stands in the scope of a denied address (``DENIED``);
* reported speech: marks what stands after a verb or noun of speech in its sentence (``REPORTED``);
* weighted patterns over the classes: the insult and threat grammar (the greatest weight of its clauses) runs composed with both scopes, the
  hate grammar and the sexual grammar (sums of weights) have their own negation and report terms.

Words alone weigh little, clauses count: an insult needs a target or an adjective, a threat a speaker and a target, hate a people.
A page's score is that of its worst sentence; 1 and over is flagged. Null, empty and blank texts score 0.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame

from .pages import Bounded, annotate
from .transducer import Grammar, Machine, Scope

# The lexicon by class, for English, German, French, Spanish, Portuguese and Finnish.
LEXICON = {
    # insults
    "I": """idiot idiots moron morons scum bitch bitches whore whores bastard bastards asshole assholes retard retards parasite parasites pig pigs shit dickhead cunt slut twat twats prick pricks wanker wankers scumbag scumbags douchebag dipshit dumbass jackass motherfucker fucker arsehole imbecile cretin lowlife
        wichser arschloch miststück schwein dreck scheiße scheisse hurensohn hure schlampe missgeburt vollidiot idioten drecksau dreckskerl drecksack fotze spast trottel schwachkopf depp penner
        imbécil cabrón gilipollas cerdo bastardo mierda puta zorra idiota coño pendejo hijoputa subnormal maricón malnacido
        connard enfoiré abruti ordure pute merde salope crétin bâtard connasse enculé conne raclure salaud
        canalha babaca porco desgraçado merda vagabunda cuzão otário arrombado corno vadia
        ääliö idiootti kusipää mulkku sika lehmä paska huora ämmä runkkari paskiainen""",
    # adjectives that go with them
    "A": """stupid filthy brainless worthless pathetic disgusting stinking lying ugly fucking dirty rotten bloody useless goddamn
        hirnloser hirnloses hirnlose wertloses wertloser widerliches widerlicher widerliche erbärmliches erbärmlicher dreckiges dreckiger dreckige dummes verdammtes verdammter elender elendes dumme
        asqueroso asquerosa miserable maldito maldita sucio sucia puto
        sale immonde minable pauvre sombre gros
        nojento nojenta miserável sujo suja imundo
        likainen surkea saatanan ällöttävä aivoton helvetin vitun""",
    # whom they are said to
    "Y": """you your you're u ya du dich dir dein deinem deine euch ihr tu tú te eres ti os t toi tes ton vous espèce você você's seu sua és sinä sinun sinut sinua teidät olet senkin""",
    # who says it, with verbs that say "I will"
    "F": """i i'll i'd i'm we we'll im ich wir werde werden yo nosotros voy vamos je j'vais nous vais eu nós vou minä aion""",
    # violent verbs, in the forms of a first person or after an auxiliary
    "J": """murder stab strangle shoot butcher slaughter behead gut gas hang lynch skin slit bash kill
        umbringen umbringe töte töten abstechen erschieße erschießen erwürge erwürgen erdrosseln aufschlitzen vergasen aufhängen totschlagen
        mato matar matarte matarlos degollar apuñalar ahorcar destripar fusilar gasear
        tuer tue égorger étrangler crever poignarder pendre buter gazer
        matar-te matá-lo esfaquear enforcar estrangular esquartejar
        tapan tappaa puukotan puukottaa kuristan ammun hirtän""",
    # being told to be silent or gone
    "s": """shut cállate callate gueule cala cale turpa klappe maul ferme""",
    # those spoken of
    "t": """them they sie los las ellos les eux eles heidät ne""",
    # what calls a people less than human
    "H": """vermin subhuman subhumans untermenschen ungeziefer alimañas infrahumanos vermine sous-hommes vermes sub-humanos syöpäläisiä ali-ihmisiä cockroaches savages abschaum""",
    "h": """rats thieves diebe ratten ladrones ratas voleurs ladrões ratos varkaita rottia""",
    # peoples and groups by their common names
    "g": """immigrants immigrant migrants refugees foreigners muslims jews blacks gays lesbians gypsies arabs asylum-seekers
        ausländer flüchtlinge juden muslime migranten asylanten zigeuner schwule
        inmigrantes refugiados extranjeros judíos musulmanes negros moros gitanos
        immigrés migrants réfugiés juifs musulmans noirs arabes étrangers
        imigrantes refugiados judeus muçulmanos ciganos estrangeiros
        maahanmuuttajat maahanmuuttajia pakolaiset pakolaisia juutalaiset juutalaisia muslimit muslimeja mutakuonot""",
    # every one of them
    "Q": """all every one alle jeder todos todas cada tous toutes chaque kaikki jokainen""",
    # what shall be done with them
    "E": """driven expelled locked deported exterminated weggesperrt vertrieben verjagt ausgerottet echarlos encerrarlos expulsarlos expulsos presos enfermer chasser expulser maasta lukkojen""",
    "K": """burn abfackeln anzünden niederbrennen quemar brûler queimar polttaa""",
    "M": """ought should must sollte müsste muss habría hay faudrait deveria devem deve deben debe müssen sollten doit doivent devrait pitäisi pitää""",
    "O": """out raus fuera dehors fora ulos""",
    "C": """country land país pays maa""",
    "N": """not never no pas não isn't aren't ain't ningún nunca jamais kein keine nicht niemals nenhum nunca koskaan kukaan yksikään""",
    # what turns a denial into its contrary: nothing but, no more than
    "b": """but only just más mais mehr more sólo solo só nur seulement kuin vain""",
    "T": """vote wählen votar voter äänestää""",
    # threats
    "W": """wait warte espero attends odotan find finde encontraré trouverai kill""",
    "B": """bleed bluten sangrar saigner vuodat""",
    "Z": """beat break smash breche schlage romperé romper casser quebrar murskaan""",
    "U": """up legs neck bones throat skull knochen beine genick schädel piernas cuello jambes cou pernas pescoço jalat""",
    "D": """stirb verreck krepier crever crève mueras muérete morra kuolet kuole""",
    # sexual
    "P": """porn porno pornos pornô xxx hardcore pornofilme""",
    "X": """sex sexo sexe seksi seksiä naked nude nudes nackte nackten desnudas peladas nues alastomat horny geile geilen putas putes salopes huorat uncensored tits fucking cocks pussy""",
    "V": """video videos vídeo vídeos vidéo vidéos clips clip cams cam webcam girls women teens frauen mujeres mulheres femmes naiset mädchen chicas contactos contacts kontakte contatos filme filmen
        filmes film films singles amateurs rencontres gratis grátis free ilmaiset ilmaisia gratuit gratuits gratuites kostenlose direct directo direto live vivo suorana adult chat seuraa""",
    # speech about it, and hating as such
    "R": """article reported quotes clinic census chronicle novel court bericht behandelt artikel reportaje artículo reportagem artigo décrit juttu käsittelee""",
    "r": """reports report hetze haine ódio""",
    "L": """hate despise loathe hasse vihaa vihaan odio odiamos déteste hais odeio""",
    "S": """dit déclaré called said says heard told alleged quoted wrote shouted sagte nannte beschimpfte rief schrieb dijo llamó gritó escribió appelait appelé traité disse chamou gritou escreveu sanoi kutsui huusi kirjoitti""",
}
# Words that start a sentence with a capital and are no people.
COMMON = """the a an i we they he she it my our your this that these those people somebody nobody everybody everyone go listen shut funny honestly get what who only
    der die das ein eine ich wir sie es halt hau jeder was wer nur dein mein dieses diese el la los las un una yo nosotros lárgate cállate todo todos vaya no
    le les un une je nous tu tout dégage ferme quelle jamais o os as um uma eu nós some cala cale que todo fora kaikki häivy turpa suu mikä tämä hän olet in on at as to if and but or for
    und aber y e et mais ja mutta""".split()
COMPOUND = re.compile(r"pornovideo|pornofilm|porn[oc]|gratisporn|freeporn|nackte|nakedgirl|sexcam|sexkontakt|contactossexo|sexvideo|desnudas|peladas|femmesnues|xxxadult|alastomat|rencontressexe|seksiseur")
# Other inflections of the graver words: stems with short endings.
STEMS = [
    (re.compile(r"(?:vermin|subhuman|untermensch|ungeziefer|alimaña|infrahuman|sous-homme|sub-humano|syöpäläi|ali-ihmi|cockroach|abschaum)\w{0,5}"), "H"),
    (re.compile(r"(?:deport|exterminat|exterminier|extermin|eradicat|expuls|expel|vertr[ie]{2}b|verjag|ausrott|ausgerott|abschieb|abgeschob|déport|expulsé|éradiqu|erradic|aniquil|karkot|hävite|tuhott)\w{0,5}"), "E"),
    (re.compile(r"(?:arschlöch|hurensöhn|schlampe|wichser|missgeburt|gilipoll|imbécil|connard|enfoiré|abruti|salope|kusipä|ääliö|idioot|idiota)\w{0,4}"), "I"),
]
# What may be called vermin or be exterminated without any hate: lower-case words that are no people.
CREATURES = set("""rats mice rabbits foxes pigeons crows insects pests weeds bugs ants wasps beetles termites diseases viruses germs species files animals ratten mäuse füchse tauben insekten schädlinge kaninchen
    ratones conejos zorros palomas insectos plagas hormigas cucarachas animales souris lapins renards insectes nuisibles animaux pragas insetos pombos coelhos raposas animais rotat hiiret jyrsijät hyönteiset tuholaiset eläimet""".split())
LED = set("the die los las les os as alle all every jeder todos todas tous toutes kaikki chaque cada jokainen".split())
TRIGGERS = frozenset("IPXpHhDBKOTZWEJjL")
# Letters of other scripts that look like these, and figures put for letters.
LOOKALIKE = str.maketrans("аеорсухіјѕԁһкмтвнАЕОРСУХІЈЅКМТВНαεοριντκ", "aeopcyxijsdhkmtbhAEOPCYXIJSKMTBHaeopivtk")
FIGURES = str.maketrans("013457$@!8", "oieastsaib")
INVISIBLE = re.compile("[​-‏⁠﻿­]")
TOKEN = re.compile(r"[#@]?[\w$*@!]*[\w$*](?:[-'’][\w$*]+)*|[.!?…,;:\n]+")
SPACED = re.compile(r"(?<![\w*])\w(?: \w)+(?![\w*])")
STRETCHED = re.compile(r"(.)\1{2,}")
FIRST = ("i", "ich", "yo", "je", "eu", "minä")

CLASS_OF = {}
for _symbol, _words in LEXICON.items():
    for _w in _words.split():
        CLASS_OF.setdefault(_w, _symbol)
SPOKEN = {w for w, c in CLASS_OF.items() if c in "IPXHhDBAV"}
MASKED: dict[tuple[int, str, str], list[str]] = {}
for _w in sorted(SPOKEN, key=lambda w: ("HIPXDBhAV".index(CLASS_OF[w]), w)):  # of words that fit a mask the graver one
    MASKED.setdefault((len(_w), _w[0], _w[-1]), []).append(_w)

#: What a class becomes within a scope: the insult grammar has no use for it but for little.
MARK = {c: chr(ord(c) + 0x400) for c in [*LEXICON, "j"]}


def _denial(state: str, symbol: str) -> tuple[str, str]:
    """Symbols without an arc: an address is remembered for two symbols, a denial holds for three."""
    if state[0] == "d" and symbol not in ",.":
        return ("free" if state == "d1" else f"d{int(state[1]) - 1}"), MARK.get(symbol, symbol)
    return ("y1" if state == "y2" and symbol not in ",." else "free"), symbol


# Negation of an address: "you are not", "aren't you"; what follows within three symbols of the clause is denied, unless a but-word comes first.
DENIED = Scope(
    {("free", "Y"): ("y2", "Y"), ("y1", "Y"): ("y2", "Y"), ("y2", "Y"): ("y2", "Y"), ("free", "N"): ("n", "N"), ("y1", "N"): ("d3", "N"), ("y2", "N"): ("d3", "N"), ("n", "Y"): ("d3", "Y"), ("n", "N"): ("n", "N")}
    | {(f"d{k}", "b"): ("free", "b") for k in (1, 2, 3)},
    _denial, "free",
)
# Reported speech: from a verb or noun of speech to the end of the sentence.
REPORTED = Scope({(s, c): ("told", c) for s in ("own", "told") for c in "RS"} | {(s, "."): ("own", ".") for s in ("own", "told")}, lambda s, c: (s, MARK.get(c, c) if s == "told" else c), "own")

# Patterns over classes with their weights. G is a capitalised word of no other class, "-" any other word; "," and "." end clauses and sentences.
INSULT = Grammar(
    [
        ("A[^.,]{0,2}I|A,A[^.,]?I", 1.0), ("Y[^.,]{0,4}I", 1.0), ("[AI][^.]{0,8}D|Y[^.]{0,2}D", 1.0), ("W[^.]{0,10}B", 1.0), ("Z[Y][^.,]?U|W[Y][^.]{0,3}Z[Y]", 1.0), ("ZYU", 1.0), ("I", 0.4),
        ("B[^.]?Y|Y[^.]{0,3}B", 0.5), ("F[^.,]{0,3}J[^.,]?Y", 1.0), ("F[^.,]{0,2}j", 1.0), ("FY-?J|YF[^.,]{0,2}J|YJ[.]", 1.0), ("s[^.]{0,3}I|D[^.]{0,2}I", 1.0), ("F[^.,]?Z[^.,]{0,2}[YU]", 1.0), (f"{MARK['I']}", 0.1),
    ],
    max,
)
HATE = Grammar(
    [
        ("[Gg][^.]*H", 0.7), ("[Gg][^.]*h", 0.4), ("Q[Gg]|Q-[Gg]|Qh|-Q[.]|[EK]-Q|Q[^.]?[Gg]", 0.3), ("[Hh][^.]*E|[Gg][^.]*E", 0.5), ("K[^.]{0,3}[Gg]|[Gg][^.]*,K", 0.5), ("M[^.]{0,2}K", 0.4), ("[Gg][O]|O[^.]?[Gg]", 0.6),
        ("O[^.]*C", 0.5), ("Q-?[Gg][^.]*M[^.]*E|E-?Q-?[Gg]", 0.5), ("N[^.]{0,4}E", -0.8), ("N", 0.3), ("T", 0.4), ("N[^.]*T", 0.4), ("R|r|L", -0.8),
        # hating a people as such, and violence against one
        ("g[^.]*H", 0.3), ("g[^.]{0,2}h", 0.3), ("g-?O|O-?g", 0.4), ("E[^.,]{0,2}g", 0.7), ("F-?L-?Q-?[Gg]|F-?L-?g", 1.8), ("[Gg][^.]*J[^.]?t|J-?Q-?[Gg]|J-?g", 1.0),
    ],
    sum,
)
SEXUAL = Grammar(
    [("p", 1.2), ("P", 0.6), ("P[^.]{0,2}[PXV]|[PXV][^.]{0,2}P|P[^.]?[PXV]", 0.6), ("P[^.]*P", 0.6), ("X[^.,]?V|V[^.,]{0,1}X|X[^.]{0,4}X", 1.0), ("[RrL]", -0.8)],
    sum,
)
INSULTS, HATES, SEX = Machine(INSULT, REPORTED, DENIED), Machine(HATE), Machine(SEXUAL)
HATEFUL = frozenset("HhKOTEJL")


def plain(token: str) -> tuple[str, bool]:
    """(word, whether it was disguised): the lexicon word behind a token, else the token in lower case."""
    low = token.lower().replace("’", "'")
    if low in CLASS_OF:
        return low, False
    some = [low]
    if not low.isascii():
        some += [unicodedata.normalize("NFKC", low), low.translate(LOOKALIKE)] if any("a" <= c <= "z" for c in low) else [unicodedata.normalize("NFKC", low)]
    more = []
    for x in some:
        if any(c.isdigit() or c in "$@!" for c in x) and any(c.isalpha() for c in x):
            more.append(x.translate(FIGURES))
    some += more
    some += [STRETCHED.sub(r"\1", x) for x in some] + [STRETCHED.sub(r"\1\1", x) for x in some]
    for x in some[1:]:
        if x in SPOKEN:
            return x, True
    if "*" in low[1:-1] and low[0] != "*" and low[-1] != "*":
        for x in some:
            for w in MASKED.get((len(x), x[0], x[-1]), ()):
                if all(a == b or a == "*" for a, b in zip(x, w, strict=True)):
                    return w, True
    return low, False


def class_of(token: str) -> str:
    c = token[0]
    if not (c.isalnum() or c in "#@$*_!"):
        return "," if set(token) <= {",", ";", ":"} else "."
    word, hidden = plain(token)
    symbol = CLASS_OF.get(word)
    if symbol is None:
        if (c == "#" or len(word) > 10) and COMPOUND.search(word.replace("-", "")):
            return "p"
        if "-" in word or "'" in word:
            last = re.split(r"[-']", word)[-1]
            symbol = CLASS_OF.get(last)
            if symbol == "J" and word.startswith(("t'", "te-")):
                symbol = "j"
            if symbol is None and last and plain(last)[1]:
                symbol = CLASS_OF.get(plain(last)[0])
    if symbol is None:
        symbol = next((c for p, c in STEMS if p.fullmatch(word)), None)
    if symbol:
        return symbol
    return "G" if c.isupper() and token[1:].islower() and word not in COMMON and not hidden else "-"


def joined(match: re.Match) -> str:
    """Spaced letters put together where they spell a word of the lexicon."""
    letters = match.group().replace(" ", "")
    for head, body, tail in (("", letters, ""), (letters[0] + " ", letters[1:], ""), ("", letters[:-1], " " + letters[-1])):
        if len(body) > 2 and plain(body)[0] in SPOKEN:
            return head + body + tail
    return match.group()


def symbols(line: str, cache: dict[str, str]) -> str:
    """The class string of a line."""
    if not line.isascii():
        line = INVISIBLE.sub("", line)
    line = SPACED.sub(joined, line)
    tokens = TOKEN.findall(line)
    out = []
    before = ""
    for t in tokens:
        s = cache.get(t)
        if s is None:
            s = cache[t] = class_of(t)
        if t in ("die", "DIE", "dead", "diе") and before.lower() in ("and", "go", "drop"):
            s = "D"
        elif s == "-" and t not in ("die", "DIE") and before in ("and", "drop") and plain(t.translate(LOOKALIKE))[0] in ("die", "dead"):
            s = "D"
        elif s == "-" and t == "ole" and before == "et":
            s = "N"
        elif s == "S" and before.lower() in FIRST:
            s = "-"
        before = t
        out.append(s)
    if "H" in out or "E" in out and any(s == "E" and STEMS[1][0].fullmatch(t.lower()) for s, t in zip(out, tokens, strict=True)):
        # a people may be written all in capitals, and in small letters in most languages
        for k in range(1, len(out)):
            t = tokens[k]
            if out[k] == "-" and tokens[k - 1].lower() in LED and len(t) > 3 and t.isalpha() and (t.isupper() or t.islower()) and t.lower() not in CREATURES and t.lower() not in COMMON:
                out[k] = "G"
    return "".join(out)


def score(classes: str) -> float:
    """Weight of the worst sentence of a class string."""
    best = 0.0
    for s in classes.split("."):
        held = frozenset(s)
        if not held & TRIGGERS:
            continue
        s += "."
        total = INSULTS.score(s)
        if ("G" in held or "g" in held) and held & HATEFUL:
            total = max(total, HATES.score(s))
        if held & {"p", "P", "X"}:
            total = max(total, SEX.score(s))
        best = max(best, total)
    return best


def line_score(line: str, cache: dict[str, str]) -> float:
    return score(symbols(line, cache))


def abusive_pages(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``abuse_score`` and ``abusive_lines`` (numbers of lines scoring 1 and over) in place of the text."""

    def work():
        known, classes = Bounded(100_000), Bounded(200_000)

        def each(texts: list[str | None]) -> list[list]:
            known.trim()
            classes.trim()
            scores, flagged = [], []
            for t in texts:
                top, lines = 0.0, []
                for i, line in enumerate(t.split("\n") if t else ()):
                    s = known.get(line)
                    if s is None:
                        s = known[line] = line_score(line, classes)
                    if s >= 0.999:
                        lines.append(i)
                    top = max(top, s)
                scores.append(float(np.round(top, 3)))
                flagged.append(lines)
            return [scores, flagged]

        return each

    return annotate(df, work, "abuse_score double, abusive_lines array<int>", text)
