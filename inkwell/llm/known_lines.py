"""Lines of scraped pages as they stand when whole.

Used to tell whole last lines from cut ones (problem 4). FURNITURE holds lines of the site around a record, RECORD lines of records: titles, headings, lists, seals, signatures and
sentences. A place or person name in them is an example and carries no weight (see ``lines.NAME_SLOT``).
"""

MENU = """Home|Contact|Help|Search|Volumes|Maps|Timeline|Glossary|Log in|Shop|Staff|Donate|Site map|Visit us|About the archive|Reading rooms|Teaching packs|Exhibits A to M
Startseite|Kontakt|Hilfe|Suche|Bände|Karten|Zeittafel|Anmelden|Lesesaal|Über das Archiv
Accueil|Connexion|Aide|Recherche|Cartes|Chronologie|Salle de lecture|À propos"""

RELATED_HEADS = """In the same volume:
Related records
More from this series
Readers also opened:"""

FURNITURE = """Marrowfield Records Project
Oskhaven Reading Room
Tolberry Document Mirror
Fenholm Papers Online
Veldale Scan Depot
Marrowfield Records Project. All rights reserved.
Oskhaven Reading Room. All rights reserved.
Tolberry Document Mirror. All rights reserved.
Fenholm Papers Online. All rights reserved.
Veldale Scan Depot. All rights reserved.
© 2015 Tolberry Document Mirror
© 2009 Marrowfield Records Project
© 2011 Oskhaven Reading Room
© 2013 Fenholm Papers Online
© 2016 Veldale Scan Depot
Hosted by the Ormerhaven University Library
You are here: Home > Volume 12 > Marrowingate
You are here: Home / Volume 19 > Haskermoor
You are here: Home » Volume 20 > Skerdale
Home > Volume 30 > Skerdale
Home / Volume 12 > Marrowvik
Home » Volume 5 > Ruskerstow
Start > Volume 28 > Yarastow
Start / Volume 28 > Ormerdale
Start » Volume 9 > Feninberry
Earlier record | Contents | Later record
<< Earlier record
Later record >>
Earlier paper
Later paper
Go back one leaf
Go on one leaf
Index of this volume
Volume list
Return to volume index
All records of Ormaheim
See also: The Braminmarket papers
Related records: Tolinreach, Tolstow
Most read this week
Advertisement
Share this page
Print | Mail | Save
[+] Enlarge text
Show image 534 of the scan
Jump to leaf 12
Loading more records...
Back to top
Top of page
Accessibility statement
Terms of use | Privacy | Imprint
Tell us what you think of the new reader
Report an error in record 2817
This page has been viewed 4411 times.
Page last changed on 22 July 2013
Follow us: letters, radio, film
Subscribe to our newsletter and receive one document a week.
Subscribe to our letter from the reading room
Your privacy matters to us. Manage choices or accept and close.
By using these pages you accept our data notice, version 6.
This site uses cookies to count visits. Accept all | Settings
We store small files on your device to remember your reading position. OK
Cookies help us keep the Dunmere collection online. By reading on you agree to their use.
Vorheriges Blatt
Inhalt des Bandes
Nächstes Blatt
Newsletter abonnieren
Impressum | Datenschutz
Alle Rechte vorbehalten.
Nach oben
Zum Seitenanfang
Barrierefreiheit
Anzeige
Diesen Text teilen
Das könnte Sie auch interessieren
Diese Website verwendet Cookies. Alle annehmen
Mit der Nutzung dieser Seiten stimmen Sie der Datenschutzerklärung zu.
Pièce précédente
Sommaire du volume
Pièce suivante
S'abonner à la lettre
Mentions légales | Confidentialité
Tous droits réservés.
Retour en haut
Haut de page
Accessibilité
Publicité
À lire aussi
Partager ce texte
Ce site utilise des témoins de connexion. Tout accepter
En poursuivant, vous acceptez notre politique de confidentialité."""

TITLES = """Daybook of the registry, 25 December 1954
Report B-133 on the Narinmere works
Record of the Yarerholm inquiry, volume 15
Evidence group M-165: Oskford
Letter from Naravik to Bramermoor, 10 April 1953
Order 40 of the Brammarket command
Papers of the Zanaberry commission, file 5
Affidavit taken at Junermoor, 5 June 1952
Minutes of the ninth session at Woldford
Proceedings of the Marrowfield Tribunal, 5 February 1951"""

RECORD = """Barrack 12: 87 persons
Wagon 213, sealed at Feninfield
Row 15: tar, rope, sailcloth
15. Lamp oil, 85 crates
(21) Rye, 497 sacks, damaged
Item 7: one ledger, bound, 8 leaves
Paid to the Caldafield council: 121 crowns
Total: 132 crates
Count 9 of the indictment
ARTICLE 5
ANNEX D-253
SCHEDULE OF EXHIBITS
Statement of facts
Preliminary remarks
Conclusions
The menu of the officers' mess at Velawick
The events at Oskberry
Contents of the Thorncombe safe
Section 21: Property removed from Lathervik
Findings as to Fenerberry
Testimony given on 25 November 1952
Next document handed up: F-343
Exhibit R-225, leaf 13
K-102. Letter of 2 April 1954
(Seal of the Bramheim registry)
Signed at Ormercombe, 14 April 1950
Certified copy, Marrowstow
Done in four languages
(s) the notary of Ormastow
Witness my hand, the clerk of Calderheim"""

PROSE = """The home page of the visitors' book at Junvik bears 366 signatures and the date 6 August 1952.
He asked to be shown the previous document, which was exhibit C-12, and read it aloud.
The cookies baked in the barracks kitchen at Skermarket were counted and 450 were found to be missing.
The search of the eighth house at Ormermoor lasted 17 hours and produced 376 letters.
All rights reserved to the crown under the treaty of Junmarket lapsed on 22 December 1949, 13 years after the signing.
The table of contents of the Ebbamere register lists 549 families, of whom 5 were still living there on 25 June 1952.
According to page 287 of the bound volume, the courier signed for 118 cases without a written order.
The subscription list was read aloud, and the witness was asked to point out his name.
By order number 67, the mayor requisitioned the evacuation plan in the presence of both delegations.
He asked for help at the reading room, but the registrar had left for the station.
The privacy of the family was respected, and the letters were sealed in the presence of counsel.
The map of the harbour was shared among the accused before the session.
The account was closed on the tenth of the month, and the price was never paid.
I was told so at Lathwick.
I saw it myself.
Les cloches furent vendues sans ordre écrit, ce que la défense ne conteste pas.
La page 440 du volume indique ceci : le douanier commanda les cloches peu après 19 heures.
Le témoin déclara : le second greffier chargea 376 caisses d'huile de lampe pendant la retraite.
Der Zollbeamte fotografierte 653 Säcke Roggen auf Verlangen des Rates.
Seite 321 des Bandes besagt: der Hafenmeister fotografierte 211 Ausweise am Bahnhof.
Der Gutachter übergab das Protokoll vom 8. November vor 118 Zeugen.
The deputy harbour master handed over the sealed orders of the northern command
when the lists were compared, the field physician conceded that
tons of copper wire behind the customs shed
percepteur classa les listes
Verlangen des Rates, wie Beweisstück zeigt."""
