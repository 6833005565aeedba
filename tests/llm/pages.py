"""Pages written by hand in layouts and words that the training pages do not have; each with its main texts and the texts of its other parts."""

STORY = [
    "The river rose twice in the same week, and nobody in the lower town slept much during those days.",
    "Volunteers carried sandbags until the early morning, when the first boats finally arrived from upstream.",
    "By Friday the water had gone back into its bed, leaving a brown line along every wall on the quay.",
]
REZEPT = [
    "Die Kartoffeln werden geschält, in dünne Scheiben geschnitten und mit etwas Salz vermengt.",
    "Danach kommt die Sahne dazu, und alles bleibt eine Stunde lang im Ofen, bis die Kruste goldbraun ist.",
]
RECIT = [
    "Le petit port se réveille tard en hiver, quand les pêcheurs attendent que le vent du nord se calme.",
    "On y trouve encore deux cafés ouverts, où les anciens jouent aux cartes jusqu'à la tombée de la nuit.",
]
NOTA = ["El puente viejo fue cerrado al tráfico después de que los técnicos encontraran grietas en uno de sus arcos.", "La reparación durará hasta el otoño y costará menos de lo que se temía al principio."]

PAGES = [
    # a table layout of old
    {
        "html": f"""<html><body bgcolor=white><table width=100%><tr><td colspan=2><img src=l.gif><font size=2>The Valley Courier - your weekly paper</font></td></tr>
<tr><td width=150><a href=1>Front page</a><br><a href=2>Sports</a><br><a href=3>Weather</a><br><a href=4>Classifieds</a></td><td><font size=5>Flood in the valley</font><p>{STORY[0]}<p>{STORY[1]}<p>{STORY[2]}</td></tr>
<tr><td colspan=2><font size=1>&copy; 2003 Valley Courier. All rights reserved.</font></td></tr></table></body></html>""",
        "main": ["Flood in the valley", *STORY], "menu": ["Front page", "Sports", "Classifieds"], "header": ["your weekly paper"], "footer": ["All rights reserved"],
    },
    # tag-free text
    {"html": "\n\n".join(STORY), "main": STORY},
    # a single paragraph
    {"html": f"<p>{REZEPT[0]}</p>", "main": REZEPT[:1]},
    # unknown class names, comments in nameless boxes
    {
        "html": f"""<!doctype html><html><body><div class="xq1"><a href="/">Home</a> <a href="/a">About us</a> <a href="/b">Contact</a></div><div class="zz-body"><h1>After the flood</h1><div>{STORY[0]}</div><div>{STORY[1]}</div><div>{STORY[2]}</div></div>
<div class="k7"><h3>3 comments</h3><div><b>Marie L. says:</b><p>Thanks for this report, great work.</p></div><div><b>old_tom wrote:</b><p>I was there too, reply to me please.</p></div></div><div class="bt">Copyright 2021 The Courier, all rights reserved</div></body></html>""",
        "main": ["After the flood", *STORY], "menu": ["About us", "Contact"], "comments": ["great work", "I was there too", "Marie L."], "footer": ["Copyright 2021"],
    },
    # comments before the article
    {
        "html": f"""<body><section class="comments"><h4>Discussion</h4><p>Bea: first!</p><p>Jo: lol, thanks</p></section><main><h1>Kartoffelgratin</h1><p>{REZEPT[0]}</p><p>{REZEPT[1]}</p></main></body>""",
        "main": ["Kartoffelgratin", *REZEPT], "comments": ["first!", "lol, thanks"],
    },
    # a shop-like portal in German
    {
        "html": f"""<body class="home"><header class="site-header"><a href=/>Kochwelt</a><nav><ul><li><a href=/r>Rezepte</a><li><a href=/k>Kontakt</a><li><a href=/i>Impressum</a></ul></nav></header><div id="cookie-layer">Wir verwenden Cookies, um diese Seite zu verbessern. <button>Akzeptieren</button></div>
<div id="content"><article><h1>Gratin</h1><p>{REZEPT[0]}</p><aside class="ad">Anzeige: Pfannen jetzt günstig kaufen!</aside><p>{REZEPT[1]}</p></article></div><aside id="sidebar"><h3>Beliebt</h3><ul><li><a href=1>Apfelkuchen</a><li><a href=2>Linsensuppe</a></ul></aside>
<form action=/nl><label>E-Mail</label><input><button>Newsletter bestellen</button></form><footer>© Kochwelt GmbH · Datenschutz</footer></body>""",
        "main": ["Gratin", *REZEPT], "menu": ["Rezepte", "Impressum"], "notice": ["verwenden Cookies", "Akzeptieren"], "ad": ["Pfannen"], "side": ["Beliebt", "Apfelkuchen"], "form": ["E-Mail", "Newsletter bestellen"], "footer": ["Kochwelt GmbH"],
    },
    # French, nested wrappers, a share bar inside the article
    {
        "html": f"""<body><div id=wrap><div class=inner><div class="topbar"><a href=#>Accueil</a> | <a href=#>Recherche</a> | <a href=#>Connexion</a></div><div class="post hentry"><h2 class="entry-title">Un port en hiver</h2><div class="share-buttons"><a href=#>Partager</a> <a href=#>Tweeter</a></div>
<div class="entry"><p>{RECIT[0]}</p><blockquote>{RECIT[1]}</blockquote></div></div><div class="related-articles"><h4>Articles similaires</h4><a href=#>La pêche en été</a><a href=#>Vents du nord</a></div><div id="footer">Mentions légales - Droits réservés</div></div></div></body>""",
        "main": ["Un port en hiver", *RECIT], "menu": ["Accueil", "Connexion"], "side": ["Partager", "Articles similaires", "La pêche"], "footer": ["Mentions légales"],
    },
    # Spanish, text between line breaks, no paragraphs
    {
        "html": f"""<html><head><title>Noticias</title></head><body><div class="menu"><ul><li><a href=/>Inicio</a></li><li><a href=/c>Contacto</a></li></ul></div><div class="texto"><h1>El puente viejo</h1>{NOTA[0]}<br><br>{NOTA[1]}<br></div><div class="publi">Publicidad: compre ahora su coche</div><div class="pie">Aviso legal. Derechos reservados.</div></body></html>""",
        "main": ["El puente viejo", *NOTA], "menu": ["Inicio", "Contacto"], "ad": ["compre ahora"], "footer": ["Derechos reservados"], "header": ["Noticias"],
    },
    # a blog with a log-in form, lists and a definition list in the article
    {
        "html": f"""<body><div role="banner"><h1><a href=/>Notes from the quay</a></h1></div><form id=login>Username <input> Password <input type=password><input type=submit value=Go></form><div role=main><h2>What to pack for a flood</h2><p>{STORY[0]}</p><ul><li>Dry socks and a warm blanket for everyone.</li><li>A torch with spare batteries.</li></ul><dl><dt>Sandbag<dd>A sack of sand that keeps water out of a doorway.</dl></div>
<div class="pagination"><a href=?p=1>Previous</a> <a href=?p=3>Next</a></div><div class="newsletter-popup">Subscribe to our newsletter and never miss a post.</div></body>""",
        "main": ["What to pack for a flood", STORY[0], "Dry socks and a warm blanket for everyone.", "A torch with spare batteries.", "A sack of sand that keeps water out of a doorway."], "header": ["Notes from the quay"], "form": ["Username", "Password"], "side": ["Previous"], "notice": ["never miss a post"],
    },
]
PARTS = ["main", "menu", "header", "footer", "side", "notice", "ad", "form", "comments"]


def by_part(read) -> dict[str, tuple[int, int]]:
    """Of each part how many of its texts ``read`` treats rightly (main: gives, others: leaves out), and how many there are."""
    out = {}
    for page, text in zip(PAGES, read([p["html"] for p in PAGES]), strict=True):
        for part in PARTS:
            for x in page.get(part, []):
                right, n = out.get(part, (0, 0))
                out[part] = (right + ((x in text) == (part == "main")), n + 1)
    return out
