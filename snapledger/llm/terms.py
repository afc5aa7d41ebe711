"""Curated subject terms.

One line per subject and language; terms are separated by ``;`` and the
writings of one term by ``/`` (a phrase may be shown by any of its telling
words, so "kicked off / kick-off" is one term).  Words of everyday or double
meaning (bank, court, trial, charge, cell, board, table, key) are left out on
purpose.  Upper and lower case do not matter.
"""

from __future__ import annotations

# The terms, by subject and language.
TERMS: dict[str, dict[str, str]] = {
    "cooking": {
        "en": "yeast; oven; soup; onion; saucepan; dough; vinegar; recipe; herring; cheesecake; garlic; butter; peeled; simmered; baked; salted; whisked",
        "da": "gæren/gær; ovnen/ovn; suppen/suppe; løget/løg; gryden/gryde; dejen/dej; eddiken/eddike; opskriften/opskrift; silden/sild; ostekagen/ostekage; "
        "hvidløget/hvidløg; smørret/smør; skrællet; simret; bagt; saltet; pisket",
        "de": "hefe; backofen; suppe; zwiebel; kochtopf; teig; essig; rezept; hering; käsekuchen; knoblauch; butter; geschält; geköchelt; gebacken; gesalzen; verquirlt",
        "fr": "levure; four; soupe; oignon; casserole; pâte; vinaigre; recette; hareng; gâteau au fromage/fromage; ail; beurre; épluché; mijoté; cuit; salé; fouetté",
    },
    "finance": {
        "en": "invoice; pension fund; currency; budget; audit; interest rate; tax refund; loan; shareholder; dividend; mortgage; stock price; overdrawn; refinanced; "
        "taxed; invested; written off",
        "da": "fakturaen/faktura; pensionskassen/pensionskasse; valutaen/valuta; budgettet/budget; revisionen/revision; renten; skatterefusionen/skatterefusion; "
        "lånet/lån; aktionæren/aktionær; udbyttet/udbytte; realkreditlånet/realkreditlån; aktiekursen/aktiekurs; overtrukket; omlagt; beskattet; investeret; afskrevet",
        "de": "rechnung; pensionskasse; währung; haushalt; buchprüfung; zinssatz; steuererstattung; kredit; aktionär; dividende; hypothek; aktienkurs; überzogen; "
        "umgeschuldet; besteuert; investiert; abgeschrieben",
        "fr": "facture; fonds de pension; devise; budget; audit; taux d'intérêt; remboursement d'impôt; prêt; actionnaire; dividende; hypothèque; cours de l'action; "
        "mis à découvert/à découvert; refinancé; imposé; investi; amorti",
    },
    "law": {
        "en": "tribunal; plaintiff; liability; appeal; contract; judge; lawyer; fine; statute; clause; witness; verdict; ratified; sued; acquitted; repealed; sworn in/sworn",
        "da": "retten; sagsøgeren/sagsøger; erstatningsansvaret/erstatningsansvar; anken/anke; kontrakten/kontrakt; dommeren/dommer; advokaten/advokat; bøden/bøde; "
        "loven/lov; klausulen/klausul; vidnet/vidne; dommen; ratificeret; sagsøgt; frikendt; ophævet; taget i ed",
        "de": "gericht; kläger; haftung; berufung; vertrag; richterin/richter; anwalt; bußgeld; gesetz; klausel; zeuge; urteil; ratifiziert; verklagt; freigesprochen; "
        "aufgehoben; vereidigt",
        "fr": "tribunal; plaignant; responsabilité civile; appel; contrat; juge; avocat; amende; loi; clause; témoin; verdict; ratifié; poursuivi en justice/en justice; "
        "acquitté; abrogé; assermenté",
    },
    "medicine": {
        "en": "vaccine; catheter; fracture; clinic; wound; fever; implant; diagnosis; surgeon; nurse; dose; patient; blood sample; bandaged; injected; "
        "examined by a doctor/examined/doctor; sterilised; treated",
        "da": "vaccinen/vaccine; kateteret/kateter; bruddet; klinikken/klinik; såret; feberen/feber; implantatet/implantat; diagnosen/diagnose; kirurgen/kirurg; "
        "sygeplejersken/sygeplejerske; dosen; patienten; blodprøven/blodprøve; forbundet; indsprøjtet; undersøgt af en læge/undersøgt/læge; steriliseret; behandlet",
        "de": "impfstoff; katheter; knochenbruch; klinik; wunde; fieber; implantat; diagnose; chirurg; pflegerin; dosis; patient; blutprobe; verbunden; injiziert; "
        "ärztlich untersucht/ärztlich/untersucht; sterilisiert; behandelt",
        "fr": "vaccin; cathéter; fracture; clinique; plaie; fièvre; implant; diagnostic; chirurgien; infirmière; dose; patient; prise de sang; bandé; injecté; "
        "examiné par un médecin/examiné/médecin; stérilisé; soigné",
    },
    "science": {
        "en": "galaxy; telescope; fossil; experiment; glacier; genome; enzyme; hypothesis; molecule; laboratory; particle; spectrum; peer reviewed/peer-reviewed; "
        "synthesised; measured in kelvin/kelvin/measured; observed under the microscope/microscope/observed",
        "da": "galaksen/galakse; teleskopet/teleskop; fossilet/fossil; eksperimentet/eksperiment; gletsjeren/gletsjer; genomet/genom; enzymet/enzym; "
        "hypotesen/hypotese; molekylet/molekyle; laboratoriet/laboratorium; partiklen/partikel; spektret/spektrum; fagfællebedømt; syntetiseret; "
        "målt i kelvin/målt/kelvin; iagttaget under mikroskop/iagttaget/mikroskop",
        "de": "galaxie; teleskop; fossil; experiment; gletscher; genom; enzym; hypothese; molekül; labor; teilchen; spektrum; begutachtet; synthetisiert; "
        "in kelvin gemessen/kelvin/gemessen; unter dem mikroskop beobachtet/mikroskop/beobachtet",
        "fr": "galaxie; télescope; fossile; expérience; glacier; génome; enzyme; hypothèse; molécule; laboratoire; particule; spectre; évalué par des pairs/pairs; "
        "synthétisé; mesuré en kelvins/mesuré/kelvins; observé au microscope/observé/microscope",
    },
    "software": {
        "en": "database; bug; password; algorithm; compiler; backup; update; browser; firmware; log file; source code; interface; refactored; compiled; encrypted; "
        "installed on the server/installed/server; debugged",
        "da": "databasen/database; programfejlen/programfejl; adgangskoden/adgangskode; algoritmen/algoritme; oversætterprogrammet/oversætterprogram; "
        "sikkerhedskopien/sikkerhedskopi; opdateringen/opdatering; browseren/browser; firmwaren/firmware; logfilen/logfil; kildekoden/kildekode; "
        "grænsefladen/grænseflade; omskrevet; kompileret; krypteret; installeret på serveren/installeret/serveren; fejlsøgt",
        "de": "datenbank; programmfehler; passwort; algorithmus; compiler; datensicherung; update; browser; firmware; protokolldatei; quellcode; schnittstelle; "
        "refaktorisiert; kompiliert; verschlüsselt; auf dem server installiert/installiert/server; entwanzt",
        "fr": "base de données; bogue; mot de passe; algorithme; compilateur; sauvegarde; mise à jour; navigateur; micrologiciel; fichier journal; code source; "
        "interface; refactorisé; compilé; chiffré; installé sur le serveur/installé/serveur; débogué",
    },
    "sport": {
        "en": "rowing club; tournament; referee; relay team; medal; penalty kick; league; goalkeeper; marathon; coach; stadium; striker; kicked off; substituted; "
        "cheered by the fans/cheered/fans; overtaken in the last lap/overtaken/lap",
        "da": "roklubben/roklub; turneringen/turnering; linjevogteren/linjevogter; stafetholdet/stafethold; medaljen/medalje; straffesparket/straffespark; ligaen/liga; "
        "målmanden/målmand; maratonløbet/maratonløb; træneren/træner; stadionet/stadion; angriberen/angriber; fløjtet i gang/fløjtet; udskiftet; "
        "hyldet af fansene/hyldet/fansene; overhalet i sidste omgang/overhalet/omgang",
        "de": "ruderverein; turnier; schiedsrichter; staffel; medaille; elfmeter; liga; torwart; marathon; trainer; stadion; stürmerin; angepfiffen; ausgewechselt; "
        "von den fans gefeiert/fans/gefeiert; in der letzten runde überholt/überholt/letzten runde",
        "fr": "club d'aviron/aviron; tournoi; arbitre; équipe de relais/relais; médaille; penalty; ligue; gardien de but/gardien; marathon; entraîneur; stade; attaquant; "
        "lancé au coup de sifflet/coup de sifflet/sifflet; remplacé à la mi-temps/mi-temps; acclamé par les supporters/acclamé/supporters; dépassé dans le dernier tour/dépassé/dernier tour",
    },
    "transport": {
        "en": "bicycle lane; tunnel; motorway; railway; locomotive; truck; timetable; cargo; harbour; ferry; bus driver; runway; towed; rerouted; "
        "unloaded at the quay/unloaded/quay; parked; delayed at the border/delayed/border",
        "da": "cykelstien/cykelsti; tunnelen; motorvejen/motorvej; jernbanen/jernbane; lokomotivet/lokomotiv; lastbilen/lastbil; køreplanen/køreplan; lasten; havnen/havn; "
        "færgen/færge; buschaufføren/buschauffør; landingsbanen/landingsbane; bugseret; omdirigeret; losset ved kajen/losset/kajen; parkeret; forsinket ved grænsen/forsinket/grænsen",
        "de": "radweg; tunnel; autobahn; eisenbahn; lokomotive; lastwagen; fahrplan; fracht; hafen; fähre; busfahrerin; landebahn; abgeschleppt; umgeleitet; "
        "am kai entladen/entladen/kai; geparkt; an der grenze aufgehalten/aufgehalten/grenze",
        "fr": "piste cyclable; tunnel; autoroute; chemin de fer; locomotive; camion; horaire des trains/horaire; cargaison; port; ferry; chauffeur de bus; "
        "piste d'atterrissage/atterrissage; remorqué; dérouté; déchargé sur le quai/déchargé/quai; garé; retardé à la frontière/retardé/frontière",
    },
}

# Further terms of general vocabulary, chosen by subject and not from any corpus.
MORE: dict[str, dict[str, str]] = {
    "cooking": {
        "en": "frying pan; casserole dish; simmer; cinnamon; parsley; thyme; lasagne; pastry; marinade; whisk; tablespoon; teaspoon; cookbook; roasted; grilled; flour; lentils; custard",
        "da": "stegepande; timian; persille; kanel; marinade; kagerulle; spiseske; teske; kogebog; ristet; grillet; hvedemel; linser; pandekager; frikadeller",
        "de": "bratpfanne; thymian; petersilie; zimt; marinade; esslöffel; teelöffel; kochbuch; gebraten; gegrillt; weizenmehl; linsensuppe; pfannkuchen; knödel; sahne",
        "fr": "cannelle; persil; thym; cuillère à soupe; cuillère à café; livre de cuisine; rôti; grillé; farine; lentilles; crêpes; ratatouille; crème fraîche; mijoter; poivron",
    },
    "finance": {
        "en": "bookkeeping; balance sheet; creditor; debtor; bankruptcy; hedge fund; treasury bond; cash flow; fiscal year; inflation; savings account; income tax; broker; equity fund; net profit",
        "da": "bogføring; kreditor; debitor; konkurs; statsobligation; pengestrøm; regnskabsår; inflation; opsparingskonto; indkomstskat; børsmægler; nettooverskud; egenkapital; kassekredit",
        "de": "buchhaltung; bilanz; gläubiger; schuldner; insolvenz; staatsanleihe; geschäftsjahr; inflation; sparkonto; einkommensteuer; börsenmakler; nettogewinn; eigenkapital; umsatzsteuer",
        "fr": "comptabilité; bilan comptable; créancier; débiteur; faillite; trésorerie; exercice fiscal; inflation; compte d'épargne; impôt sur le revenu; courtier; bénéfice net; fonds propres; obligation d'état",
    },
    "law": {
        "en": "defendant; prosecutor; jury; subpoena; plea bargain; injunction; affidavit; jurisdiction; felony; barrister; solicitor; testimony; litigation; indictment; constitutional; notary",
        "da": "anklager; nævninge; stævning; jurisdiktion; forbrydelse; retssag; vidneudsagn; notar; højesteret; grundloven; straffeloven; forsvarer; kendelse; voldgift",
        "de": "angeklagter; staatsanwalt; geschworene; vorladung; zuständigkeit des gerichts; rechtsstreit; zeugenaussage; notar; bundesgericht; grundgesetz; strafgesetzbuch; verteidiger; schiedsverfahren; anklageschrift",
        "fr": "accusé; procureur; jurés; assignation; juridiction; infraction; litige; témoignage; notaire; cour suprême; code pénal; plaidoirie; arbitrage judiciaire; inculpation",
    },
    "medicine": {
        "en": "antibiotic; vaccination; physician; stethoscope; anaesthesia; chemotherapy; tumour; insulin; blood pressure; symptom; asthma; diabetes; prescription; paediatrician; ultrasound; scalpel",
        "da": "antibiotikum; vaccination; stetoskop; narkose; kemoterapi; svulst; insulin; blodtryk; symptom; astma; diabetes; sukkersyge; børnelæge; ultralyd; hjerteanfald",
        "de": "antibiotikum; impfung; stethoskop; narkose; chemotherapie; tumor; insulin; blutdruck; symptom; asthma; diabetes; kinderarzt; ultraschall; herzinfarkt; skalpell",
        "fr": "antibiotique; vaccination; stéthoscope; anesthésie; chimiothérapie; tumeur; insuline; tension artérielle; symptôme; asthme; diabète; pédiatre; échographie; ordonnance médicale; scalpel",
    },
    "science": {
        "en": "photosynthesis; quantum; neutron; electron; supernova; evolution of species; chromosome; tectonic; astrophysics; isotope; catalyst; gravity; nebula; biodiversity; thermodynamics; botanist",
        "da": "fotosyntese; kvantemekanik; neutron; elektron; supernova; kromosom; astrofysik; isotop; katalysator; tyngdekraft; stjernetåge; biodiversitet; termodynamik; botaniker",
        "de": "photosynthese; quantenmechanik; neutron; elektron; supernova; chromosom; astrophysik; isotop; katalysator; schwerkraft; nebula; artenvielfalt; thermodynamik; botaniker",
        "fr": "photosynthèse; mécanique quantique; neutron; électron; supernova; chromosome; astrophysique; isotope; catalyseur; gravité terrestre; nébuleuse; biodiversité; thermodynamique; botaniste",
    },
    "software": {
        "en": "operating system; repository; runtime; stack trace; unit test; open source; programming language; middleware; cloud computing; javascript; python script; api endpoint; kernel; deployment; malware; website",
        "da": "styresystem; programmeringssprog; enhedstest; fejlrettelse; skadelig software; hjemmeside; webserver; tekstfil; brugerflade; cloudtjeneste; computerprogram; softwareudvikler",
        "de": "betriebssystem; programmiersprache; komponententest; schadsoftware; webseite; webserver; benutzeroberfläche; softwareentwickler; rechenzentrum; quelltext; fehlermeldung; laufzeitumgebung",
        "fr": "système d'exploitation; langage de programmation; test unitaire; logiciel malveillant; site web; serveur web; interface utilisateur; développeur de logiciels; centre de données; message d'erreur; informatique en nuage; bibliothèque logicielle",
    },
    "sport": {
        "en": "football; basketball; tennis; midfielder; championship; olympic; gymnast; cyclist; sprinter; half-time; world cup; swimmer; handball; athletics; quarter-final; offside",
        "da": "fodbold; håndbold; basketball; tennis; midtbanespiller; mesterskab; olympisk; gymnast; cykelrytter; sprinter; halvleg; verdensmesterskab; svømmer; atletik; kvartfinale",
        "de": "fussball; handball; basketball; tennis; mittelfeldspieler; meisterschaft; olympisch; turnerin; radrennfahrer; sprinter; halbzeit; weltmeisterschaft; schwimmerin; leichtathletik; viertelfinale",
        "fr": "football; handball; basket-ball; tennis; milieu de terrain; championnat; olympique; gymnaste; cycliste; sprinteur; coupe du monde; nageuse; athlétisme; quart de finale; hors-jeu",
    },
    "transport": {
        "en": "airport; tram; freight train; container ship; pedestrian crossing; traffic jam; commuter; lorry; roundabout; level crossing; passenger train; metro line; shipping lane; airline; car park; diesel engine",
        "da": "lufthavn; sporvogn; godstog; containerskib; fodgængerfelt; trafikprop; pendler; rundkørsel; passagertog; metrolinje; flyselskab; parkeringsplads; varevogn; togstation; banegård",
        "de": "flughafen; strassenbahn; güterzug; containerschiff; zebrastreifen; verkehrsstau; pendler; kreisverkehr; personenzug; u-bahn; fluggesellschaft; parkplatz; lieferwagen; bahnhof; spedition",
        "fr": "aéroport; tramway; train de marchandises; porte-conteneurs; passage piéton; embouteillage; banlieusard; rond-point; ligne de métro; compagnie aérienne; parking; camionnette; gare routière; passage à niveau; péage",
    },
}

#: Weight of words of everyday or double meaning: many of them do not make up for one telling term.
WEAK_WEIGHT = 0.15

# Words of everyday or double meaning, by the subject they may point to.
WEAK: dict[str, str] = {
    "cooking": "salt; pepper; pan; plate; dish; kitchen; salz; pfanne; küche; køkken; tallerken; cuisine; sel; assiette",
    "finance": "bank; share; bond; interest; balance; account; charge; konto; kurs; zinsen; banque; compte; intérêt",
    "law": "court; trial; case; sentence; party; bar; bench; sag; dom; fall; recht; cour; procès; droit",
    "medicine": "cell; operation; ward; shock; pulse; celle; puls; zelle; schock; cellule; choc; pouls",
    "science": "field; matter; culture; solution; space; felt; rum; feld; raum; lösung; champ; espace",
    "software": "table; key; window; mouse; cloud; bus; shell; tabel; nøgle; vindue; maus; fenster; tabelle; souris; fenêtre; clé",
    "sport": "match; goal; ball; net; pitch; club; score; mål; kamp; tor; spiel; but; jeu; filet",
    "transport": "train; platform; track; station; port; line; bane; spor; zug; gleis; voie; ligne; gare",
}
