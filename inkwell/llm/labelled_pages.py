"""Scraped pages labelled by hand, from which the line weights are trained.

Each page is a block; a line that begins with ``-`` is furniture of the site, one with ``+`` belongs to the record, one with
``=`` heads a list of other records, and ``~`` stands before those, which look like titles of the record itself. Sites,
places and persons are made up and occur in no table; names weigh nothing beyond these pages.
"""

PAGES = """- Harrowdale County Archive
- Home | Collections | Maps | Timeline | Contact | Help
- We use cookies to improve your visit. Accept all | Reject
- You are here: Home > Collections > Volume 4
+ Minutes of the third session at Elmsworth
+ Testimony given on 3 March 1948
+ The town clerk of Elmsworth stated under oath that he had handed over 40 crates of lamp oil to the garrison, and that no receipt was given.
+ He was asked for the list. It was never found.
+ ARTICLE 7
+ 12. Rope, 30 coils
+ 13. Blankets, 112 bales, damaged
+ Total: 142 pieces
+ (Seal of the Elmsworth registry)
+ Signed at Elmsworth, 4 March 1948
- Previous record | Contents | Next record
= Related records
~ Letter from Brackwater to Hollin, 2 May 1947
~ Order 12 of the Hollin command
- Share this page
- Print | Mail | Save
- Back to top
- © 2012 Harrowdale County Archive. All rights reserved.
- Terms of use | Privacy | Accessibility

- The Saltmarsh Papers
- Search
- Log in
- Register
- Shop
- Donate
- Glossary
- Visit us
- About the archive
- Reading rooms
- Teaching materials
- Site map
- Advertisement
+ Letter from Penmoor to the governor, 9 July 1951
+ Exhibit D-14, leaf 2
+ Sir, the bridge has been closed since the first of the month, and the families on the far side have had no bread.
+ I asked the commandant twice for a pass and was refused both times.
+ The register of 3 June lists 219 men, of whom 17 were still in the camp when the commission came.
+ Witness my hand, the clerk of Penmoor
+ Certified copy, Penmoor
- << Earlier letter
- Later letter >>
- Return to the index
- Volume list
- Index of this volume
- Go to page 14
- Show image 12 of the scan
- Enlarge text
- Loading more pages...
- Most read this week
= Readers also opened:
~ Report 9 on the Penmoor works
- Subscribe to our newsletter
- Follow us: radio, letters, film
- This page has been viewed 310 times.
- Page last changed on 8 May 2014
- Tell us what you think of this page
- Report an error in page 112
- Report a problem with record 7
- © 2014 The Saltmarsh Papers
- Hosted by the university library
- © 2008 Saltmarsh Map Room
- © 2019 Penmoor Court Records

- Nordholm Digital Library
- Contact
- Help
- Search
- Maps
- Volumes
- Timeline
- Staff
- By using this site you accept our privacy notice, version 3.
- Your privacy matters to us. Manage your choices or accept and close.
+ Proceedings of the inquiry, 14 October 1949
+ THE PRESIDENT: When did you last see the ledger?
+ I saw it myself on the table of the paymaster, and I signed for it.
+ The doctor was present, but he did not speak.
+ Preliminary remarks
+ Under paragraph 5 of the order the stores were to be opened in the presence of two witnesses.
+ The keys of the depot were kept by the night watchman, as the whole street knew.
+ Count 2 of the indictment
+ Wagon 77, sealed at the border
+ Hut 3: 54 persons
+ Paid to the council: 90 crowns
+ Statement of facts
+ Conclusions
+ Findings as to the second charge
+ Section 4: Property removed from the school
+ Contents of the safe
+ The events at the harbour
+ (s) the notary
+ Done in two languages
- See also: The Wexcombe papers
- Related records: Wexcombe, Lowmere
= More from this series
= In the same volume:
~ Daybook of the office, 3 January 1950
~ Affidavit taken at Lowmere, 6 April 1950
~ Evidence group A-2: Wexcombe
- Next document
- Previous document
- Top of page
- Sign up for our letter
- We store files on your device to remember your reading place. OK
- Cookies help us keep this collection online. By reading on you agree to their use.
- All records of Wexcombe
- Imprint | Privacy | Terms of use

- Archiv der Grafschaft
- Startseite | Suche | Bände | Karten | Hilfe | Kontakt
- Anmelden
- Zeittafel
- Lesesaal
- Über das Archiv
- Diese Seite verwendet Cookies. Alle annehmen
- Mit der Nutzung stimmen Sie der Datenschutzerklärung zu.
+ Protokoll der Sitzung vom 4. Mai 1950
+ Der Zeuge erklärte, er habe den Schlüssel am Abend dem Hafenmeister übergeben.
+ Der Schreiber las die Liste vor, und niemand widersprach.
+ Auf Verlangen des Gerichts wurde der Brief vom 2. April verlesen.
+ Die Kisten standen im Hof der Schule, wie mehrere Nachbarn bestätigten.
+ Der Arzt prüfte 14 Ausweise, was der Angeklagte bestreitet.
- Vorheriges Blatt
- Nächstes Blatt
- Inhalt des Bandes
- Zum Seitenanfang
- Nach oben
- Diesen Text teilen
- Anzeige
- Das könnte Sie auch interessieren
- Newsletter abonnieren
- Barrierefreiheit
- Impressum | Datenschutz
- Alle Rechte vorbehalten.

- Bibliothèque du Comté
- Accueil | Recherche | Cartes | Aide | Connexion
- Chronologie
- Salle de lecture
- À propos
- Ce site utilise des cookies et des témoins de connexion. Tout accepter
- En poursuivant, vous acceptez notre politique de confidentialité.
+ Procès-verbal de la séance du 4 mai 1950
+ Le témoin déclara qu'il avait remis la clef au maire, et que personne ne l'avait demandée.
+ La commission entendit le notaire, puis le médecin du village.
+ Le greffier lut la liste à haute voix, ce que la défense ne conteste pas.
+ Les caisses furent comptées devant deux témoins le 3 juin 1950.
+ Il fut promu pour cela.
- Pièce précédente
- Pièce suivante
- Sommaire du volume
- Haut de page
- Retour en haut
- Partager ce texte
- Publicité
- À lire aussi
- S'abonner à la lettre
- Accessibilité
- Mentions légales | Confidentialité
- Tous droits réservés.

- Coldwater Record Office
- Home / Volume 9 / Coldwater
- Home » Volume 2 » Coldwater
- Start > Volume 3 > Coldwater
- Earlier paper
- Later paper
- Exhibits A to D
+ Record of the Coldwater inquiry, volume 2
+ Order 3 of the Coldwater command
+ Affidavit taken at Coldwater, 3 July 1949
+ Evidence group B-7: Coldwater
+ Daybook of the registry, 1 May 1950
+ Report C-8 on the Coldwater works
+ Papers of the harbour commission, file 3
+ The home of the widow was searched twice, and her letters were read aloud by the guard.
+ All the rights of the crown in the land lapsed under the treaty of that year.
+ The contents of the next box were shared among the men before the search was over.
+ He asked to see the previous document, and said that the page had been cut.
+ The cookies and the tea were kept for the officers, the soldiers had bread.
+ For help he went to the station, but the office was closed at 6 o'clock.
+ The menu of the mess hall, 2 May
+ Item 3: one box, locked
+ Row 5: tar, nails, canvas
+ (4) Wheat, 12 sacks
+ SCHEDULE OF EXHIBITS
+ ANNEX 3
+ when the lists were compared, the mayor conceded that
+ tons of copper wire behind the shed
+ nobody in the village was told.
+ I was told so at the mill.
+ the burning of the papers
+ F-12. Letter of 9 June 1950
+ Next document handed up: C-12
- Contact | Staff | Help
- Print this page
- Jump to page 3
- Go back one page
- Go on one page
- Table of contents
- Subscribe to our newsletter and receive one letter a month.
- Page updated on 3 March 2016
- See also: The mill papers
- Related papers: Coldwater, Lowmere
- What do you think of the new site?
- Tell us what you think
- © 2016 Coldwater Record Office"""
