"""The small labelled table that the personal-data model is trained on: marked sentences made from patterns and drawn fillers.

Patterns, names and number formats are written from general knowledge of how people give their data in six languages, not from any corpus.
Names are drawn from common given names and surnames of many countries and, as often, from syllables that spell nobody's name, so that the
place and the shape of a name count more than the word; formats are put together from parts with varied separators. Rows without personal
data (orders, parts, prices, dates, headlines, menus, firms, places) teach what to leave alone.
"""

from __future__ import annotations

import random
import re

#: Rows of the table.
ROWS = 11_000
SEED = 20

# Common given names and surnames, from general knowledge; a feature of the model and no condition.
GIVEN = """Aaron Abigail Adam Adrian Agnes Agnieszka Ahmad Akira Alan Albert Aleksi Alejandro Alessandro Alexander Alfred Ali Alice Alina Amanda Amelia Amina Amir Ana Andrea Andreas Andrew Angela Anita Anja Anke Anna Anne Annika Anthony Antonio Antti Arthur Arvid Astrid
    Axel Barbara Bartosz Beata Benjamin Bernd Bernard Bettina Birgit Bogdan Brian Brigitte Bruno Camilla Carla Carlos Carolina Caroline Catherine Cecilia Charles Charlotte Chinedu Christian Christina Christopher Claire Clara Claudia Claude Cristina Dagmar Daniel David Deborah Denis Diana Diego Dieter Dirk
    Dmitry Dolores Dominik Donald Dorothy Eduardo Edward Eeva Ekaterina Elena Elif Elisabeth Elizabeth Emil Emily Emma Emmanuel Enrique Erik Ernst Esther Eugenia Eva Fabian Fatma Felix Fernanda Fernando Filip Florian Francesca Francisco Frank Franz Frederik Friedrich Gabriel Gabriela Georg George Gerhard Gisela Giulia
    Gloria Gonzalo Greta Guillaume Gustavo Hanna Hannah Hans Harry Haruto Hassan Heidi Heinz Helena Hendrik Henrik Hiroshi Hugo Ibrahim Igor Ilse Inga Ingrid Irene Isabel Ivan Jack Jacob Jacques James Jan Jane Janne Jari Jason Javier Jean Jennifer Jens Jessica Jiří Joana Johan Johanna John Jorge José Joseph Joshua João Juan Judith Juha Jukka
    Julia Jürgen Kaisa Karen Karl Karin Karolina Kateřina Katharina Kathleen Kevin Khadija Klaus Krzysztof Kurt Lars Laura Lea Leena Leo Leonardo Liam Lina Linda Lisa Lorenzo Louis Louise Lucas Lucia Luís Luisa Luiz Lukas Magdalena Maja Manuel Marc Marcel Marcos Margaret Margarida Maria Marie Mario Mark Markus
    Marta Martin Mary Matthew Matthias Matti Max Mercedes Michael Michelle Miguel Mikko Milan Minna Mohammed Monika Mustafa Nancy Natalia Nathalie Nicolas Nicole Nikolai Nina Nora Oliver Olga Olivia Omar Oscar Pablo Patricia Patrick Paul Paula Pedro Pekka Peter Petra Philipp Philippe Pierre Pilar Pirjo Rachel Rafael Raimo Rainer Ramón
    Raquel Rebecca Ricardo Richard Rita Robert Roberto Roger Roland Rosa Ruth Ryan Salma Samuel Sandra Santiago Sara Sari Sebastian Sergei Silvia Simon Sofia Sofie Sophie Stefan Stefanie Stephen Steven Sven Tanja Tatiana Tero Thomas Timo Tomás Tomasz Tuomas Ulla Ulrich Ursula Valentina Vera Veronika
    Victor Vincent Virginia Walter William Wolfgang Xavier Yasmin Yuki Yusuf Yvonne Zofia""".split()  # fmt: skip
SURNAMES = """Adams Ahmadi Almeida Andersson Bauer Becker Bernard Brown Carvalho Clark Costa Davies Dubois Durand Evans Fernández Ferreira Fischer Fontaine Garcia Gómez Gonzalez Green Hall Hämäläinen Heikkinen Hill Hoffmann Huber Ivanov Jackson Jansen Johnson Jones Khan Kim
    King Klein Koch Kowalski Kovács Krüger Laine Lambert Laurent Lee Lefebvre Leroy Lewis Lima López Mäkinen Martinez Martins Meyer Moore Moreau Morris Müller Nakamura Neumann Nguyen Nieminen Novak Nowak Oliveira Parker Patel Pereira Pérez Petit Popescu Richter Rivera Roberts Robinson
    Rodríguez Rossi Roux Ruiz Salminen Sánchez Santos Scott Schmidt Schneider Schulz Schwarz Silva Singh Smith Sousa Suzuki Taylor Thompson Torres Turner Vargas Virtanen Wagner Walker White Williams Wilson Wolf Wright Yılmaz Zimmermann""".split()  # fmt: skip
ENDINGS = "a o e i n s r l na th ck k ne vic holm son berg mann eau ez es ova inen ski sky nen lla rra tti ano ard et le ier ow in er el ic"
# What streets, towns and firms are named after.
STREETS = {
    "en": "Church Mill Station High Park Victoria Oak Chapel Bridge Maple Elm Cedar Main Queen Garden Orchard River Spring Lake Forest Sunset Washington",
    "de": "Haupt Bahnhof Garten Schiller Goethe Linden Mühlen Kirch Berg Schul Wald Rosen Beethoven Markt Ring Friedhof Wiesen Dorf Post Brunnen",
    "fr": "Victor-Hugo République Liberté Gambetta Moulin Église Lilas Pasteur Voltaire Jaurès Fontaine Roses Foch Tilleuls Verdun Mairie",
    "es": "Mayor Real Sol Constitución Goya Cervantes Luna Rosales Prado Libertad Iglesia Olmo Colón Alcalá Estación Fuente",
    "pt": "Augusta Direita Liberdade Flores Bandeira Palmeiras República Independência Matriz Laranjeiras Aurora Pinheiros Boavista Almirante",
    "fi": "Kirkko Koulu Asema Puisto Ranta Mänty Koivu Mannerheimin Puro Harju Niitty Myllyn Pelto Kauppa Satama Lehto",
}
TOWNS = "burg ville ford haven wick mouth stad dorf heim ton field bach lahti saari mar vila ona eda".split()
THINGS = "bicycle curtain ladder printer jacket pillow teapot drill hammer tent cushion mirror scarf helmet basket shelf radiator keyboard".split()

# Usual entries of menus.
MENU = "Home News Archive Gallery Help Contact Shop Jobs Login Forum Events Downloads Basket Account Imprint Privacy Startseite Aktuelles Hilfe Kontakt Anmelden Impressum Accueil Aide Panier Connexion Inicio Ayuda Noticias Contacto Carrito Início Ajuda Contato Carrinho Etusivu Haku Ohjeet Ostoskori"
# {n} name, {e} e-mail, {p} phone, {i} identity number, {a} address; {N} place, {F} firm, {#} a number that is no personal data, {w} a thing.
SENTENCES = {
    "en": """Hello, this is {n} speaking.|I am {n}, your new neighbour from {a}.|Please contact {n} by e-mail: {e}|Any questions? Write to {e} or ring {p}.|You may ring {n} on {p} after six.|Mobile: {p}|Tel: {p}|Phone {p}|Fax: {p}|E-mail {e}|Mail: {e}|Contact: {n}
        Author: {n}|By {n}|Text: {n}|Photo by {n}|Edited by {n}|Signed, {n}|Kind regards, {n}|Best wishes {n}|Mr {n} has lived at {a} since May.|Mrs. {n} moved to {a}, {N}.|Dr {n} sees patients at {a}.|Ms {n} of {N} won the prize.|Professor {n} gave the lecture.|Ask for {n} at the desk.
        Parcels go to {a}, {N}.|Our shop is at {a}.|Find us at {a}, just behind the station.|Postal address: {a}, {N}|Venue: {a}|SSN: {i}|His social insurance number is {i}.|National insurance number {i} was given on the form.|Passport no. {i}|ID card {i} issued to {n}|Driving licence {i}, holder {n}
        Taxpayer number: {i}|The clerk wrote down {i} as the tax identification of {n}.|Leave a message for {n} ({e}).|Reply to {e}.|Send your CV to {e}.|Drop {n} a line at {e} or come to {a}.|Registered by {n} on 12 March|Thanks to {n} and {n} for their help.|Yesterday {n} called from {p}.
        For refunds text {p}.|The winner, {n}, lives at {a}.|Her personal number {i} appeared on the badge.|Moderator: {n}|Coach: {n}, {p}|Treasurer {n}, {e}|Our secretary is {n}.|Speak with {n}, extension below: {p}|I, {n}, born in {N}, hold identity document {i}.|We moved to {a} last year.|Take the bus to {a} or walk to {a} from here.|Letters to {a} before Monday arrive in time.|Bring it to {a} or mail {e}.|From tomorrow {a} is our home, call {p} as before.|Call {p} and ask for {n}.|Is {n} in today?|{a} in {N} is for sale.|We met at {a} in {N} and talked.|The house at {a} near the church burned down.|I live at {a} in {N}, says {n}.|The lease of {a} ends before June.|Reach {n} at {e}.|{n} can be found at {e} most days.""",
    "de": """Guten Tag, hier spricht {n}.|Ich heiße {n} und wohne {a}.|Ihre Ansprechperson: {n}, {p}|Fragen beantwortet {n} gern unter {e}.|Sie erreichen uns unter {p}.|Handy: {p}|Tel.: {p}|Telefonnummer {p}|Fax: {p}|E-Mail: {e}|Mail an {e} genügt.|Kontakt: {n}|Autor: {n}|Autorin: {n}
        Von {n}|Text: {n}|Foto: {n}|Bearbeitet von {n}|Viele Grüße, {n}|Ihr {n}|Hochachtungsvoll {n}|Herr {n} ist umgezogen, neue Adresse: {a}.|Frau {n} arbeitet in {N}.|Frau Dr. {n} hat Sprechstunde, {a}.|Prof. Dr. {n} hielt den Vortrag.|Bitte bei {n} melden.|Pakete bitte an {a}, {N}.
        Unser Laden: {a}|Sie finden uns {a}, gleich hinter dem Bahnhof.|Postanschrift: {a}, {N}|Treffpunkt: {a}|Personalausweis {i}, ausgestellt auf {n}|Reisepass Nr. {i}|Steuer-ID: {i}|Ihre Sozialversicherungsnummer lautet {i}.|Im Formular stand die Nummer {i} des Ausweises.|Führerschein {i}
        Bewerbungen an {e}.|Rückruf unter {p} bei {n}.|Danke an {n} und {n}!|Gestern rief {n} an ({p}).|Die Gewinnerin {n} wohnt {a}.|Trainer: {n}, {p}|Kassenwart {n}, {e}|Verantwortlich: {n}, {a}|Geschäftsführerin: {n}|Ich, {n}, wohnhaft {a}, Ausweis {i}.|Bringen Sie es zu {a} oder an {e}.|Wir sind letztes Jahr nach {a} gezogen.|Rufen Sie {p} an, ob {n} da ist.|Ist {n} heute da?|Das Haus {a} in {N} steht leer.|{n} ist unter {e} zu finden.""",
    "fr": """Bonjour, ici {n} à l'appareil.|Je suis {n}, j'habite au {a}.|Votre interlocutrice : {n}, {p}|Pour toute question, écrire à {e}.|Vous nous trouverez au {a}, derrière la gare.|Portable : {p}|Tél : {p}|Téléphone {p}|Télécopie : {p}|E-mail : {e}|Mél. {e}|Contact : {n}|Auteur : {n}|Par {n}
        Texte : {n}|Photo : {n}|Propos recueillis par {n}|Cordialement, {n}|Bien à vous, {n}|Monsieur {n} a déménagé au {a}.|Madame {n} travaille à {N}.|Le docteur {n} consulte au {a}.|M. {n} et Mme {n} sont présents.|Adressez-vous à {n}.|Les colis vont au {a}, {N}.|Notre boutique : {a}
        Adresse postale : {a}, {N}|Lieu : {a}|Carte d'identité n° {i} au nom de {n}|Passeport {i}|Numéro fiscal : {i}|Son numéro de sécu est le {i}.|Le formulaire portait le numéro {i}.|Permis de conduire {i}|Envoyez votre CV à {e}.|Rappelez {n} au {p}.|Merci à {n} et à {n}.
        Hier {n} a téléphoné ({p}).|La gagnante, {n}, habite {a}.|Entraîneur : {n}, {p}|Trésorière {n}, {e}|Directrice : {n}|Je soussigné {n}, demeurant {a}, pièce {i}.|Le Pr {n} répond à {e}.|Portez-le au {a} ou à {e}.|Nous avons quitté le {a} hier.|Composez le {p} et demandez {n}.|Est-ce que {n} est là ?|Écrivez à l'adresse {e}.|On trouve {n} à l'adresse {e}.|L'immeuble du {a} est à vendre.|J'habite {a} à {N}, dit {n}.""",
    "es": """Hola, soy {n}.|Soy {n} y vivo en {a}.|Persona de contacto: {n}, {p}|Para cualquier duda escriba a {e}.|Nos encontrará en {a}, detrás de la estación.|Móvil: {p}|Tel.: {p}|Teléfono: {p}|Fax: {p}|Correo electrónico: {e}|E-mail {e}|Contacto: {n}|Autor: {n}|Autora: {n}|Por {n}
        Texto: {n}|Foto: {n}|Un saludo, {n}|Atentamente, {n}|El señor {n} se mudó a {a}.|La señora {n} trabaja en {N}.|El doctor {n} atiende en {a}.|Don {n} y doña {n} asistieron.|Hable con {n}.|Los paquetes van a {a}, {N}.|Nuestra tienda: {a}|Dirección postal: {a}, {N}|Lugar: {a}
        DNI {i} a nombre de {n}|Pasaporte n.º {i}|NIE: {i}|Su número de la seguridad social es {i}.|En el formulario figuraba el documento {i}.|Permiso de conducir {i}|Envíe su currículum a {e}.|Llame a {n} al {p}.|Gracias a {n} y a {n}.|Ayer llamó {n} ({p}).
        La ganadora, {n}, vive en {a}.|Entrenador: {n}, {p}|Tesorera {n}, {e}|Directora: {n}|Yo, {n}, con domicilio en {a} y documento {i}.|La profesora {n} responde en {e}.|Llévelo a {a} o a {e}.|Nos mudamos a {a} ayer.|Marque el {p} y pregunte si está {n}.|La casa de {a} en {N} se vende.|Encontrará a {n} en {e}.|Vivo en {a}, dice {n}.""",
    "pt": """Olá, aqui fala {n}.|Sou {n} e vivo na {a}.|Pessoa de contacto: {n}, {p}|Para qualquer dúvida escreva para {e}.|Estamos na {a}, atrás da estação.|Celular: {p}|Tel.: {p}|Telefone: {p}|Fax: {p}|Correio eletrónico: {e}|E-mail {e}|Contato: {n}|Autor: {n}|Autora: {n}|Por {n}
        Texto: {n}|Foto: {n}|Um abraço, {n}|Atenciosamente, {n}|O senhor {n} mudou-se para a {a}.|A senhora {n} trabalha em {N}.|O doutor {n} atende na {a}.|Dona {n} e seu {n} vieram.|Fale com {n}.|As encomendas vão para {a}, {N}.|Nossa loja: {a}|Morada: {a}, {N}|Local: {a}
        CPF {i} em nome de {n}|Passaporte n.º {i}|NIF: {i}|O RG dela é {i}.|No formulário constava o documento {i}.|Carta de condução {i}|Envie o currículo para {e}.|Ligue a {n} pelo {p}.|Obrigado a {n} e a {n}.|Ontem ligou {n} ({p}).
        A vencedora, {n}, vive na {a}.|Treinador: {n}, {p}|Tesoureira {n}, {e}|Diretora: {n}|Eu, {n}, residente na {a}, portador do documento {i}.|A professora {n} responde em {e}.|Leve-o a {a} ou a {e}.|Mudámos para {a} ontem.|Marque {p} e pergunte se {n} está.|A casa da {a} em {N} está à venda.|Encontra {n} em {e}.|Moro na {a}, diz {n}.""",
    "fi": """Hei, täällä puhuu {n}.|Olen {n} ja asun osoitteessa {a}.|Yhteyshenkilö: {n}, {p}|Kysymykset voi lähettää osoitteeseen {e}.|Löydät meidät osoitteesta {a}, aseman takaa.|Matkapuhelin: {p}|Puh: {p}|Puhelin {p}|Faksi: {p}|Sähköpostiosoite: {e}|S-posti {e}|Yhteys: {n}|Kirjoittaja: {n}
        Teksti: {n}|Kuva: {n}|Terveisin {n}|Ystävällisin terveisin, {n}|Herra {n} muutti osoitteeseen {a}.|Rouva {n} on töissä paikassa {N}.|Tohtori {n} ottaa vastaan: {a}.|Professori {n} piti luennon.|Kysy lisää: {n}|Paketit osoitteeseen {a}, {N}.|Myymälämme: {a}|Postiosoite: {a}, {N}|Paikka: {a}
        Henkilökortti {i}, haltija {n}|Passi nro {i}|Hetu: {i}|Hänen henkilötunnuksensa on {i}.|Lomakkeessa oli tunnus {i}.|Ajokortti {i}|Lähetä hakemus: {e}|Soita {n}, {p}.|Kiitos {n} ja {n}!|Eilen soitti {n} ({p}).|Voittaja {n} asuu osoitteessa {a}.
        Valmentaja: {n}, {p}|Rahastonhoitaja {n}, {e}|Johtaja: {n}|Minä, {n}, osoite {a}, tunnus {i}.|Opettaja {n} vastaa: {e}|Tuo se osoitteeseen {a} tai {e}.|Muutimme osoitteeseen {a} eilen.|Soita {p} ja kysy, onko {n} tavattavissa.|Talo {a} on myynnissä.|Minut tavoittaa: {n}, {e}.|Asun osoitteessa {a}, sanoo {n}.""",
}
# What identity numbers are called, and how they are given: every term goes with every frame.
TERMS = {
    "en": ("social security number|social security number|Social Security Number|SSN|national insurance number|identity number|personal number|tax number|tax ID|passport number|identity card number|driving licence number|ID number|insurance number",
           "{T}: {i}|{T} {i}|My {T} is {i}.|The {T} {i} belongs to {n}.|{n}, {T} {i}|We need your {T}, for example {i}.|On page two stood the {T} {i}.|The {T} {i} was read out loud.|Somebody had copied the {T} {i} from the letter.|The card of {n} has the {T} {i}."),
    "de": ("Sozialversicherungsnummer|Ausweisnummer|Personalausweisnummer|Passnummer|Steuernummer|Steueridentifikationsnummer|Identitätsnummer|Personennummer|Versicherungsnummer|Führerscheinnummer",
           "{T}: {i}|{T} {i}|Meine {T} ist {i}.|Die {T} {i} gehört zu {n}.|{n}, {T} {i}|Auf Seite zwei stand die {T} {i}.|Die {T} {i} wurde laut verlesen.|Jemand hatte die {T} {i} abgeschrieben.|Auf der Karte von {n} steht die {T} {i}."),
    "fr": ("numéro de sécurité sociale|numéro de sécurité sociale|numéro d'identité|numéro de carte d'identité|numéro de passeport|numéro fiscal|numéro personnel|numéro de permis|numéro d'assuré",
           "{T} : {i}|{T} {i}|Mon {T} est le {i}.|Le {T} {i} appartient à {n}.|{n}, {T} {i}|À la page deux se trouvait le {T} {i}.|Le {T} {i} a été lu à voix haute.|Quelqu'un avait copié le {T} {i}.|La carte de {n} porte le {T} {i}."),
    "es": ("número de la seguridad social|número de la seguridad social|número de identidad|DNI|NIE|NIF|número de pasaporte|documento de identidad|número fiscal|número personal",
           "{T}: {i}|{T} {i}|Mi {T} es {i}.|El {T} {i} pertenece a {n}.|{n}, {T} {i}|En la página dos estaba el {T} {i}.|El {T} {i} se leyó en voz alta.|Alguien había copiado el {T} {i}.|La tarjeta de {n} lleva el {T} {i}."),
    "pt": ("número da segurança social|número de identidade|CPF|NIF|RG|número do passaporte|bilhete de identidade|número de contribuinte|número pessoal",
           "{T}: {i}|{T} {i}|Meu {T} é {i}.|O {T} {i} pertence a {n}.|{n}, {T} {i}|Na página dois estava o {T} {i}.|O {T} {i} foi lido em voz alta.|Alguém tinha copiado o {T} {i}.|O cartão de {n} traz o {T} {i}."),
    "fi": ("henkilötunnus|sosiaaliturvatunnus|passin numero|henkilökortin numero|verotunnus|ajokortin numero",
           "{T}: {i}|{T} {i}|Minun {T} on {i}.|{n}, {T} {i}|Sivulla kaksi oli {T} {i}.|Ääneen luettiin {T} {i}.|Joku oli kopioinut: {T} {i}.|Kortissa ({n}) on {T} {i}."),
}
# What other numbers are called, and how they are given.
OTHERS = {
    "en": ("order number|part number|item number|invoice number|reference|serial number|tracking number|ISBN|model number|case number|ticket|lot number", "{T}: {#}|{T} {#}|The {T} {#} was changed.|Please quote {T} {#}.|With the {T} {#} it works again.|We replaced {T} {#} last year.|{w}, {T} {#}"),
    "de": ("Bestellnummer|Teilenummer|Artikelnummer|Rechnungsnummer|Seriennummer|Sendungsnummer|ISBN|Modellnummer|Vorgangsnummer|Bestellung|Lieferung", "{T}: {#}|{T} {#}|Die {T} {#} wurde geändert.|Bitte {T} {#} angeben.|Mit der {T} {#} geht es wieder.|{w}, {T} {#}"),
    "fr": ("numéro de commande|numéro de pièce|référence|numéro de facture|numéro de série|numéro de suivi|ISBN|commande|pièce", "{T} : {#}|{T} {#}|La {T} {#} a changé.|Merci d'indiquer {T} {#}.|Avec la {T} {#} tout marche.|{w}, {T} {#}"),
    "es": ("número de pedido|número de pieza|referencia|número de factura|número de serie|ISBN|pedido|pieza|modelo", "{T}: {#}|{T} {#}|La {T} {#} ha cambiado.|Indique {T} {#}.|Con {T} {#} funciona.|{w}, {T} {#}"),
    "pt": ("número da encomenda|número da peça|referência|número da fatura|número de série|ISBN|encomenda|peça|modelo", "{T}: {#}|{T} {#}|A {T} {#} mudou.|Indique {T} {#}.|Com {T} {#} funciona.|{w}, {T} {#}"),
    "fi": ("tilausnumero|osanumero|tuotenumero|laskun numero|sarjanumero|ISBN|tilaus|varaosa|malli", "{T}: {#}|{T} {#}|Uusi {T} {#} toimii.|Ilmoita {T} {#}.|{w}, {T} {#}"),
}
#: Rows of staff lists and the like: any two or three data beside each other.
GAPS = [", ", " · ", " | ", "\t", "  ", " - ", "; ", " / "]
LEADS = ["", "", "", "- ", "* ", "• ", "Dr. ", "Prof. ", "1. ", "Mr ", "Frau ", "Mme "]
PLAIN = """Order {#} left the warehouse on Monday.|Item number {#} replaces the old {w}.|ISBN {#}|See invoice {#} for the price of the {w}.|Article {#}, colour blue, size 42|Ticket {#} was closed.|Bestellnummer {#}: ein {w}.|Artikelnummer {#} ist lieferbar.|Rechnung {#} vom 3. Mai|Das Aktenzeichen lautet {#}.
    N° de commande {#}|La référence {#} est épuisée.|Facture {#} du 3 mai|Número de pedido {#}|La referencia {#} está agotada.|Factura {#} del 3 de mayo|Número da encomenda {#}|A referência {#} esgotou.|Tilausnumero {#}|Tuote {#} on loppu.|Lasku {#} lähetettiin eilen.|Serial {#}, model {#}
    © 2015 {F}|Copyright {F}, all rights belong to their owners|{F} opened a branch in {N}.|{F} eröffnet eine Filiale in {N}.|{F} ouvre une agence à {N}.|{F} abre una sucursal en {N}.|{F} abre uma filial em {N}.|{F} avaa myymälän: {N}.|The bridge at {N} dates from 1894.|Die Brücke in {N} stammt von 1894.
    Le pont de {N} date de 1894.|El puente de {N} es de 1894.|A ponte de {N} é de 1894.|{N} on kaunis kesällä.|We spent a week in {N} and two days in {N}.|Wir fuhren von {N} nach {N}.|De {N} à {N} il faut trois heures.|From {N} to {N} it is 48 miles.|Between 1850 and 1912 the town of {N} grew fast.
    The {w} costs 49.90, delivery is free.|Der Preis fiel um 12,5 % auf 84,30 Euro.|Le prix baisse de 12 % (84,30 euros).|El precio bajó un 12 % hasta 84,30 euros.|O preço caiu 12 %, para 84,30 euros.|Hinta laski 12 prosenttia 84,30 euroon.|{#};{w};12.5;880;3|{w} | 12 | 440 | 9.75|7,{w},33,1.5|{w} {w} {w} cheap {w}
    {w}\t12\t19.5|Chapter {w} ........ 88|1. {w}|2) {w} (1987)|* {w}|[7] {N}, vol. 12, pp. 88-91.|https://www.{f}.example/{w}/4417|www.{f}.example|#{f} #{w}|@{f}{w}|Follow @{f} for news.|Home > {w} > Details|Home | Search | Contact | Imprint|Startseite · Suche · Kontakt|Accueil - Recherche - Contact
    Inicio / Buscar / Contacto|Início » Busca » Contato|Etusivu | Haku | Yhteystiedot|Terms of use · Privacy|Top of page|Newsletter|Latest news from {N}|New arrivals this week: {w}, {w}, {w}|Sale! {w} -30 % only today|BEST {w} DEALS {N}|Buy {w} online, {w} sale, cheap {w} {N}
    Section 14 of the act applies.|Gemäß § 14 Absatz 2 gilt dies nicht.|L'article 14 s'applique.|Se aplica el artículo 14.|Aplica-se o artigo 14.|Pykälä 14 ei koske tätä.|It began at 18:30 and ended at 21:05.|Version 4.2.1 fixes error 0x80070057.|Build 20391 passed 412 tests in 33.2 seconds.|git commit 9fceb02 broke the parser
    3f9a 77bc 01de 45aa 9b2c|10.0.17.254|A8 9C 44 F1|48.2082, 16.3738|The match ended 3:1 after extra time.|Nach der Pause stand es 2:0.|Temperatures reach 31 degrees in {N}.|King Henry the Eighth had six wives.|Queen Victoria reigned for 63 years.|Kaiser Wilhelm dankte 1918 ab.|The Grand Hotel {N} is full.|Mount {N} is 2,104 metres high.
    The Old Town Hall, {N}|Saint {N} Cathedral|High Court of {N}|University of {N}|Lake {N} froze over.|River {N} rose by a metre.|Supreme Court, March 1999|Third Round, Second Half|The Red {w} and the Blue {w}|The Last {w}: A Novel|Der rote {w}|La Casa Grande|O Rio Grande|Vanha {w}
    On Monday nobody came.|Am Montag kam niemand.|Lundi, personne n'est venu.|El lunes no vino nadie.|Na segunda ninguém veio.|Maanantaina kukaan ei tullut.|My brother asked for the {w}.|Her uncle, a baker from {N}, laughed.|The doctor called twice.|Die Lehrerin aus {N} lachte.|The captain of {N} scored twice.
    Call before noon, please.|Write in capitals.|Ask at the desk.|Visit the {w} museum.|Rufen Sie vor zwölf an.|Appelez avant midi.|Llame antes del mediodía.|Ligue antes do meio-dia.|Soita ennen puoltapäivää.|The signature was missing.|Unterschrift fehlt.|{w}: {N}|{w} – {N}|{w} | {N}|The {w} ({N}, 1899) was sold.
    Main Street was closed for repairs.|The road runs along the river.|Die Hauptstraße war gesperrt.|La rue était vide.|La calle estaba cerrada.|A rua estava vazia.|Katu oli tyhjä.|Station Road is 3 miles long.|12 apples, 3 pears and 1 {w}|Track 4, platform 12, coach 7|Sitzplatz 42, Wagen 7|Parkplatz 118 ist frei.|Er steht auf Listenplatz 7.|Startplatz 12 blieb leer.|Sie kam auf Rang 14.|Place 12 sur 40|Puesto 12 de 40|Lugar 12 de 40|Sija 12|Brot, Käse, Wein, Obst und Gemüse|Pain, Fromage, Vin|Bread, Cheese, Wine|Room 12, floor 3|Page 3 of 12|Updated 03.05.2011 14:22|2019-03-14 11:02:45 INFO started"""  # fmt: skip


class Maker:
    """Draws fillers; one seed, so the table never changes."""

    def __init__(self, seed: int = SEED):
        self.r = random.Random(seed)

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def digits(self, pattern: str) -> str:
        """A pattern whose 9 stand for any figure and A for any capital."""
        return "".join(str(self.r.randrange(10)) if c == "9" else chr(65 + self.r.randrange(26)) if c == "A" else c for c in pattern)

    def syllables(self, n: int) -> str:
        onset = "b d f g h j k l m n p r s t v w z c q x y ch sh th br kr tr st gr pl dr fl sk".split()
        return "".join(self.r.choice(onset) + self.r.choice("a a e e i i o o u u y ä é ia ei ou ö".split()) + self.r.choice(["", "", "", "n", "r", "l", "s", "m"]) for _ in range(n))

    def invented(self) -> str:
        """A word that is nobody's name."""
        return (self.syllables(self.r.randrange(1, 3)) + self.r.choice(ENDINGS.split())).capitalize()

    def given(self) -> str:
        return self.r.choice(GIVEN) if self.r.random() < 0.55 else self.invented()

    def surname(self) -> str:
        one = lambda: self.r.choice(SURNAMES) if self.r.random() < 0.35 else self.invented()
        return one() + ("-" + one() if self.r.random() < 0.1 else "")

    def place(self) -> str:
        return self.syllables(self.r.randrange(1, 3)).capitalize() + self.r.choice(TOWNS)

    def firm(self) -> str:
        return self.pick(self.place(), self.invented(), f"{self.invented()} & {self.invented()}") + self.pick(" Group", " Media", " GmbH", " Ltd.", " Verlag", " S.A.", " Oy", "", " Inc.")

    def name(self) -> str:
        g, s, i = self.given(), self.surname(), chr(65 + self.r.randrange(26))
        k = self.r.random()
        out = f"{g} {s}" if k < 0.6 else f"{s}, {g}" if k < 0.72 else f"{i}. {s}" if k < 0.84 else f"{g} {i}. {s}" if k < 0.94 else f"{g} {self.given()} {s}" if k < 0.97 else f"{s}, {i}."
        k = self.r.random()
        return out.upper() if k < 0.07 else out.lower() if k < 0.14 else out

    def email(self) -> str:
        g, s = self.given().lower(), self.surname().lower()
        sep = self.pick(".", "_", "-", "")
        user = self.r.choice([f"{g}{sep}{s}", f"{g[0]}{s}", f"{g[0]}.{s}", f"{s}{self.r.randrange(100)}", f"{g}{sep}{s}+list", f"{g[0]}.{s[0]}", self.r.choice("info contact office team sales hello mail service support admin_1 no-reply kontakt".split()), f"{g}{self.r.randrange(1950, 2010)}"])
        host = self.syllables(self.r.randrange(1, 3)).lower() + self.pick("", "", "", "-online", "web", "mail", "-verein", "shop", ".uni")
        end = self.pick("example", "test", "invalid", "co.uk", "org", "com", "de", "fr", "es", "fi", "pt", "net", "com.br", "info", "co.example")
        k = self.r.random()
        if k < 0.55:
            out = f"{user}@{host}.{end}"
        elif k < 0.63:
            out = f"{user}＠{host}.{end}"
        elif k < 0.7:
            out = f"{user}&#64;{host}.{end}"
        else:
            a, b = self.pick("[]", "()", "[]", "{}", "  "), self.pick("", " ")
            at = f" {self.pick('at', 'AT')} " if a == "  " else f"{b}{a[0]}{self.pick('at', 'at', 'AT', ' at ')}{a[1]}{b}"
            dot = "." if self.r.random() < 0.4 else f" {self.pick('dot', 'DOT')} " if a == "  " else f"{b}{a[0]}dot{a[1]}{b}"
            out = f"{user}{at}" + f"{host}.{end}".replace(".", dot)
        k = self.r.random()
        return out if "&" in out or k > 0.06 else out.upper() if k < 0.03 else out.title()

    def groups(self, total: int, sep: str) -> str:
        """So many figures in groups of two to five."""
        out = []
        while total:
            n = total if total < 4 else self.r.choice([2, 2, 3, 3, 4, 5] if total > 5 else [2, 3, total])
            n = total if total - n == 1 else min(n, total)
            out.append("9" * n)
            total -= n
        return sep.join(out)

    def phone(self) -> str:
        """Country, area and groups with one separator or another, and sometimes an extension."""
        sep = self.pick(" ", " ", " ", "-", ".", "", "\u00a0")
        k = self.r.random()
        rest = self.groups(self.r.randrange(6, 9), sep)
        if k < 0.4:
            code = self.pick("1", "44", "49", "33", "34", "351", "358", "55", "43", "41", "39", "31", "46")
            lead = self.pick(f"+{code}", f"+{code}", f"00{code}", f"(+{code})") + self.pick(" ", sep, sep) + self.pick("", "", "(0)")
            out = lead + self.digits(self.pick("9", "99", "999", "(999)", "(99)")) + (self.pick(" ", sep) if sep else "") + rest
        elif k < 0.62:
            out = self.pick("0", "0", "0", "(0") + self.digits(self.pick("9", "99", "999", "9999"))
            out += (")" if out[0] == "(" else "") + self.pick(" ", "/", "-", " / ", sep, sep) + rest
        elif k < 0.78:
            out = self.pick("999-999-9999", "(999) 999-9999", "999.999.9999", "999 999 9999", "1-999-999-9999", "+1 999-999-9999", "1 (999) 999-9999", "+1 (999) 999-9999", "+19999999999", "099/99999999", "0999/9999999", "0999/999999", "099/9999999")
        elif k < 0.9:
            out = (sep or " ").join(self.pick("99 99 99 99 99", "999 99 99 99", "999 999 999", "9999 9999", "99 9999 9999", "(99) 9999-9999", "(99) 99999-9999", "99 99999-9999", "999-999999").split(" "))
        else:
            out = self.pick("999999999", "9999999999", "+99999999999", "0999999999", "0999999999", "09999999")
        if self.r.random() < 0.12:
            out += self.pick(" ext. 99", " ext 999", " x99", ", ext. 9", "-99")
        return self.digits(out)

    def identity(self) -> str:
        """Public formats of identity, tax, insurance, passport and licence numbers."""
        p = self.r.choice([
            "999-99-9999", "999 99 9999", "AA 99 99 99 A", "AA999999A", "AA9999999", "A99999999", "A9999999", "A99A99999", "A99A99A99", "99 999999 A 999", "99999999A999", "99999999999", "99 999 999 999",
            "9 99 99 99 999 999 99", "999999999999999", "99999999A", "99999999-A", "99.999.999-A", "A9999999A", "A-9999999-A", "999.999.999-99", "999999999-99", "99.999.999-9", "999 999 999", "999999-999A", "999999A999A", "999999-9999",
            "99/999/99999", "AA-999999", "999999999", "AAA999999", "99AA99999", "99 99 999999 99",
        ])
        return self.digits(p)

    def address(self, lang: str) -> str:
        n = str(self.r.randrange(1, 190)) + (self.r.choice("abcd") if self.r.random() < 0.12 else "")
        s = self.r.choice(STREETS[lang].split()) if self.r.random() < 0.4 else self.syllables(self.r.randrange(1, 3)).capitalize() + self.r.choice(["", "", "er", "n", "a", "o"])
        flat, floor = str(self.r.randrange(1, 40)), self.r.randrange(1, 9)
        if lang == "en":
            street = f"{self.pick('', '', '', 'Old ', 'New ', 'West ', 'Upper ')}{s} " + self.pick("Street", "St", "St.", "Road", "Rd", "Lane", "Ave.", "Avenue", "Close", "Drive", "Court", "Square", "Way", "Terrace", "Crescent", "Place", "Hill", "Blvd", "Gardens")
            k = self.r.random()
            return f"{n} {street}" if k < 0.5 else f"{n} {street}, {self.pick('Apt', 'Apt.', 'Flat', 'Unit', 'Suite', 'Apartment', '#')} {flat}" if k < 0.75 else f"{self.pick('Flat', 'Apartment', 'Unit')} {flat}, {n} {street}"
        if lang == "de":
            street = self.pick(f"{s}straße", f"{s}str.", f"{s}strasse", f"{s}weg", f"{s}gasse", f"{s}allee", f"{s}platz", f"Am {s}", f"Im {s}", f"An der {s}mühle", f"Zum {s}hof", f"{s}er Straße", f"{s}er Weg", f"{s}ring", f"{s}ufer", f"Am {s}platz", f"An der {s}brücke")
            return f"{street} {n}" + self.pick("", "", "", "", f", {floor}. Stock", f", Whg. {flat}")
        if lang == "fr":
            lead = n if self.r.random() < 0.7 else n.rstrip("abcd") + self.pick(" bis", " ter")
            of = self.pick("", "du ", "de la ", "de ", "des ", "de l'")
            end = self.pick("", "", "", "", f", appt {flat}", f", {floor}e étage", f", bât. {self.r.choice('ABC')}")
            return f"{lead}{self.pick(',', '')} " + self.pick("rue ", "avenue ", "av. ", "bd ", "boulevard ", "place ", "allée ", "impasse ", "chemin ", "quai ", "route ", "cours ") + of + s + end
        if lang == "es":
            of = self.pick("", "", "de ", "del ", "de la ", "de los ")
            end = self.pick("", "", "", f", {floor}º {self.r.choice('ABCD')}", f", {floor}º {self.pick('izq.', 'dcha.', 'izda.')}", f", piso {floor}", f", {floor}.º")
            return self.pick("Calle ", "C/ ", "C. ", "Avenida ", "Av. ", "Avda. ", "Plaza ", "Paseo ", "Camino ", "Ronda ", "Travesía ") + of + s + self.pick(", ", ", ", " ", ", n.º ") + n + end
        if lang == "pt":
            of = self.pick("", "", "de ", "do ", "da ", "dos ", "das ")
            end = self.pick("", "", "", f", {floor}º {self.pick('esq.', 'dto.', 'Esq.', 'Dto.')}", f", apto {flat}", f", ap. {flat}", f", bloco {self.r.choice('ABC')}", f", {floor}º andar")
            return self.pick("Rua ", "R. ", "Travessa ", "Avenida ", "Av. ", "Largo ", "Praça ", "Alameda ", "Estrada ") + of + s + self.pick(", ", ", ", " ", ", nº ") + n + end
        return s.capitalize() + self.pick("katu ", "tie ", "ntie ", "polku ", "kuja ", "nkatu ", "nkuja ", "ranta ", "kaari ", "aukio ", "penger ", "raitti ") + n + self.pick("", "", f" {self.r.choice('ABCD')} {flat}", f" {self.r.choice('ABC')}", f" as. {flat}")

    def number(self) -> str:
        return self.digits(self.r.choice(["9999-9999", "99-99-9999", "9999 999999", "9999/99999", "999 99 999", "9999-999", "9999 99", "9999-999999", "999-99-999", "978-9-99-999999-9", "99999", "9999 9999", "99-999", "9999/999", "A-99999", "AA99-999", "999-9999-9", "999-99-9999"]))

    def row(self, pattern: str, lang: str) -> tuple[str, list[tuple[int, int, str]]]:
        """(text, spans) of a pattern."""
        kinds = {"n": "name", "e": "email", "p": "phone", "i": "id_number", "a": "address"}
        make = {"n": self.name, "e": self.email, "p": self.phone, "i": self.identity, "a": lambda: self.address(lang), "N": self.place, "#": self.number, "F": self.firm, "w": lambda: self.r.choice(THINGS), "f": lambda: self.syllables(2)}
        text, spans = "", []
        for part in re.split(r"(\{.\})", pattern):
            if len(part) == 3 and part[0] == "{" and part[1] in make:
                filled = make[part[1]]()
                if part[1] in kinds:
                    spans.append((len(text), len(text) + len(filled), kinds[part[1]]))
                text += filled
            else:
                text += part
        return text, spans

    def listing(self) -> str:
        """A pattern of one to four data beside each other."""
        gap = self.r.choice(GAPS)
        rest = [x for x in ("{p}", "{e}", "{a}") if self.r.random() < 0.5]
        if self.r.random() < 0.3:
            self.r.shuffle(rest)
        some = ["{n}", *rest] if rest == [] or self.r.random() < 0.85 else rest
        return (self.r.choice(LEADS) if some[0] == "{n}" else "") + gap.join(some)

    def junk(self) -> str:
        """A row of codes, figures, prices, capitalised words or tags."""
        r = self.r
        k = r.randrange(9)
        word = lambda: self.pick(r.choice(THINGS), self.syllables(2), self.syllables(3))
        if k == 0:
            wide = r.choice([2, 4, 4, 8])
            return " ".join("".join(r.choice("0123456789abcdef") for _ in range(wide)) for _ in range(r.randrange(3, 16)))
        if k == 1:
            gap = r.choice([";", ",", " | ", "\t", "    "])
            return gap.join([str(r.randrange(1, 60)), self.pick("", "the ", "der ", "la ") + word(), *(f"{r.random() * 999:.{r.randrange(3)}f}" for _ in range(r.randrange(2, 7)))])
        if k == 2:
            return "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(r.randrange(20, 90))) + self.pick("", "=", "==")
        if k == 3:
            return f"{word()} {self.place() if r.random() < 0.4 else ''} {self.digits(self.pick('A9999', 'AAA99999', '9999', 'A-999'))} {r.random() * 200:.2f} {self.pick('', '€', '$', 'EUR', '-20 %')} {self.pick('', 'buy', 'best', 'kaufen', 'online')} {word()}"
        if k == 4:
            some = [self.pick(word(), f"{word()} {self.syllables(1)}", r.choice(MENU.split()), r.choice(MENU.split())).capitalize() for _ in range(r.randrange(3, 7))]
            return self.pick("", "", "#,", "Tags: ", "1. ") + r.choice([", ", "; ", " | ", ",", ";", " - ", " - ", " · ", " / ", "   ", " > ", " » "]).join(some if r.random() < 0.7 else [x if r.random() < 0.5 else f"#{x.lower()}" for x in some])
        if k == 5:
            return " ".join(self.digits("9" * r.randrange(1, 7)) for _ in range(r.randrange(3, 12)))
        if k == 6:
            return f"{word().capitalize()} {self.pick('........', '–', ':', '|')} {r.randrange(400)}"
        if k == 7:
            return self.pick("*", "-", f"{r.randrange(30)}.", ">") + " " + self.pick("the ", "das ", "le ", "el ", "") + word() + self.pick("", f" ({r.randrange(100)})", f" {self.place()}")
        return self.pick(f"{word().upper()} {word().upper()} {self.digits('A9999 99.99')} -{r.randrange(60)}%", f"<{word()} id=\"{word()}{r.randrange(99)}\">", f"{word()}: {word()} {self.place()}, {word()} {word()}, {word()} online", f"{r.randrange(2, 24):02d}:{r.randrange(60):02d} {self.place()}, {self.place()}")

    def blurred(self, pattern: str) -> str:
        """A pattern with some of its small words put into nobody's language, so that what stands around counts less than what is there."""
        return re.sub(r"(?<![\w{@.#/])[^\W\d_A-ZÀ-Þ]{3,}(?![\w}@.])", lambda m: self.syllables(self.r.randrange(1, 4)) if self.r.random() < 0.5 else m.group(), pattern)


def table(rows: int = ROWS, seed: int = SEED, keep: range | None = None, of: int = 5) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The labelled table: sentences, list rows, and rows without personal data.

    ``keep`` leaves only patterns whose number modulo ``of`` is in it, to hold some out.
    """
    m = Maker(seed)
    split = lambda text: [x for k, x in enumerate(y for y in (y.strip() for y in re.split(r"\||\n", text)) if y) if keep is None or k % of in keep]
    sentences = {lang: split(text) for lang, text in SENTENCES.items()}
    framed = {kind: {lang: (terms.split("|"), split(text)) for lang, (terms, text) in of_kind.items()} for kind, of_kind in (("id", TERMS), ("other", OTHERS))}
    plain = split(PLAIN.replace(" | ", " ¦ "))
    out = []
    for _ in range(rows):
        lang, k = m.r.choice(list(sentences)), m.r.random()
        if k < 0.3:
            pattern = m.r.choice(sentences[lang])
        elif k < 0.48:
            terms, texts = framed["id" if k < 0.41 else "other"][lang]
            term = m.r.choice(terms)
            frame = m.r.choice(texts)
            pattern = (m.blurred(frame) if m.r.random() < 0.4 else frame).replace("{T}", term if m.r.random() < 0.7 else term.capitalize() if m.r.random() < 0.7 else term.upper())
        elif k < 0.7:
            pattern = m.listing()
        elif k < 0.85:
            pattern = m.r.choice(plain)
        else:
            out.append((m.junk(), []))
            continue
        if m.r.random() < 0.25:
            # sentences stand beside each other on a line
            other = m.r.choice(plain if m.r.random() < 0.6 else sentences[lang])
            pattern = f"{other} {pattern}" if m.r.random() < 0.5 else f"{pattern} {other}"
        text, spans = m.row(m.blurred(pattern) if not 0.3 <= k < 0.48 and m.r.random() < 0.4 else pattern, lang)
        out.append((text.replace("¦", "|"), spans))
    return out
