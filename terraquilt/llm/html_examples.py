"""A small table of labelled blocks: pages, and the blocks of each that are its main text."""

_LONG = "The river had been rising since the early morning and by noon the lower road was closed to all traffic from the south"
_MORE = "Nobody on the council could say how long the repairs would take or who in the end was going to pay for the new bridge"
_LAST = "A second report is due before the summer and it will name the stretches of the bank that have to be moved back first"

EXAMPLES: list[tuple[str, set[str]]] = [
    (  # an article with everything around it
        f"""<html><head><title>Rising water</title></head><body><header><div class="logo">The Daily Page</div><a href="/">Home</a></header>
        <nav><ul><li><a href="/n">News</a></li><li><a href="/s">Sport today</a></li></ul></nav>
        <div class="cookie-consent">We use cookies to make this page work better for you and our partners. <button>Fine</button></div>
        <div class="ad">Buy three pairs of shoes today and get one more pair for free in all our shops.</div>
        <article><h1>Rising water</h1><p>{_LONG}.</p><p>Closed.</p><h2>Who pays</h2><p>{_MORE}.</p>
        <ul><li>The old bridge stays open on foot</li><li>Lorries take the north road</li></ul>
        <p>Read <a href="/x">the first report on the river and its bridges</a></p>
        <aside class="related"><p>More about rivers: five walks along the water that you should not miss this year.</p></aside></article>
        <section class="comments"><h3>Comments</h3><article><p>I have lived there for twenty years and the road has never been closed before.</p></article></section>
        <form><label>Your mail</label><p>Get our letter every morning, written for you by our editors.</p></form>
        <footer><p>&copy; The Daily Page and its partners, all rights reserved in every country.</p></footer></body></html>""",
        {"Rising water", f"{_LONG}.", "Closed.", "Who pays", f"{_MORE}.", "The old bridge stays open on foot", "Lorries take the north road",
         "Read the first report on the river and its bridges"},
    ),
    (  # text beside the main element is not of the article
        f"""<body><div>Friday edition of the paper</div><p>Weather: sunny with some clouds in the late afternoon, and cool at night.</p>
        <main><p>{_LAST}.</p><p>Short one</p><table><tr><td>Bank</td><td>moved back</td></tr></table></main>
        <div>This text stands beside the main part and tells how to read the paper on a telephone.</div></body>""",
        {f"{_LAST}.", "Short one", "Bank", "moved back"},
    ),
    (  # no main element: long blocks with few links, and what stands between them
        f"""<body><div><a href="/">Home</a> <a href="/a">About us</a> <a href="/b">Contact</a></div><h1>Banks to be moved</h1>
        <p>{_LONG}.</p><p>So it was.</p><p>{_MORE}.</p><p>{_LAST}.</p>
        <div><a href="/1">Ten more stories that our readers liked this week and last week</a></div>
        <div>Follow us</div><div>Top</div></body>""",
        {"Banks to be moved", f"{_LONG}.", "So it was.", f"{_MORE}.", f"{_LAST}."},
    ),
    (
        f"""<body><table><tr><td><a href="/">Start</a></td><td><a href="/z">Index of pages</a></td></tr></table>
        <div>{_MORE}, he said. {_LAST}.</div><br><div>{_LONG} and from the north.</div>
        <div id="footer">Printed on paper by hand. Ask us about the price of one hundred copies.</div><div class="share">Send it to a friend</div></body>""",
        {f"{_MORE}, he said. {_LAST}.", f"{_LONG} and from the north."},
    ),
    (  # a page of links has no main text
        """<body><ul><li><a href="/1">One page about the sea and its fish</a></li><li><a href="/2">Two</a></li><li><a href="/3">Three pages in all</a></li></ul>
        <div>Page 1 of 9</div></body>""",
        set(),
    ),
    ("<body>Moved.</body>", {"Moved."}),
    (  # one short text is all there is
        "<body><p>The shop is closed on Monday.</p></body>",
        {"The shop is closed on Monday."},
    ),
    (
        f"""<body><div class="sidebar"><p>{_LAST}, says the editor.</p></div><div class="post"><h2>Notes</h2><p>{_LONG}.</p><p>End</p></div>
        <div class="newsletter"><p>{_MORE}? Sign up and be the first to know.</p></div><div style="display: none">{_MORE} hidden.</div></body>""",
        {"Notes", f"{_LONG}.", "End"},
    ),
    (  # long texts outside the main element, and parts within and around it
        f"""<body><div>{_MORE}, as we wrote in our last issue, which you can still buy in all shops.</div><div class="notice">Closed today</div>
        <article><header><h1>Floods</h1></header><p>{_LONG}.</p><p>It will last until spring at least, the office for water says.</p>
        <div class="ad">Shoes</div><p>{_LAST}.</p><footer>Filed under water and roads</footer></article>
        <div>{_LAST}, but this is only what we tell at the foot of every page.</div></body>""",
        {"Floods", f"{_LONG}.", "It will last until spring at least, the office for water says.", f"{_LAST}."},
    ),
    (  # no main element, marked parts right beside the text, short paragraphs among long ones
        f"""<body><div class="menu">Start</div><div id="search-form">Find a page</div><h1>Moved back</h1><p>By our man at the river, with all that is known so far today.</p>
        <p>{_LONG}.</p><p>It will last until spring at least, the office for water says.</p><p>{_MORE}.</p>
        <p>He did not want to say when that would be.</p><div class="sponsored">{_LAST}, and our new boots keep your feet dry.</div>
        <p>{_LAST}.</p><div class="comment">Well said, and long overdue if you ask me, as nobody ever does.</div><div class="copyright">The Daily Page</div></body>""",
        {"Moved back", "By our man at the river, with all that is known so far today.", f"{_LONG}.",
         "It will last until spring at least, the office for water says.", f"{_MORE}.", "He did not want to say when that would be.", f"{_LAST}."},
    ),
    (
        f"""<body><nav>Start Pages Index</nav><p>{_MORE}.</p><p>Others had asked for the same thing three years ago.</p><p>Twice.</p>
        <p>{_LONG}.</p><ul><li><a href="/1">Next story</a></li><li><a href="/2">Last story</a></li></ul><footer>{_LAST}</footer></body>""",
        {f"{_MORE}.", "Others had asked for the same thing three years ago.", "Twice.", f"{_LONG}."},
    ),
    (
        f"""<body><div class="menu">Weather</div><main><p>Rain.</p><p>More rain, and then some sun.</p><p><a href="/r">All of it in numbers</a></p><p>And sun again.</p><div class="related">Snow</div></main>
        <div class="side">{_LONG}</div><div>About us and what we do</div></body>""",
        {"Rain.", "More rain, and then some sun.", "All of it in numbers", "And sun again."},
    ),
    (
        f"<body><article><h1>Sun</h1><p>{_LONG}.</p><p>The end.</p></article></body>",
        {"Sun", f"{_LONG}.", "The end."},
    ),
    (
        "<body><article><h2>Moon</h2><p><a href='/m'>Moon</a></p><p>Full.</p></article></body>",
        {"Moon", "Full."},
    ),
    (  # marks on what is or contains the main element
        f"""<body><div class="menu">Start</div><div class="layout widget-area"><article class="review"><h1>Lamps</h1><p>{_LONG}.</p><p>Fine.</p></article>
        <section class="comments"><article><p>I have one and like it.</p></article></section></div></body>""",
        {"Lamps", f"{_LONG}.", "Fine."},
    ),
    (
        f"""<body><div class="layout has-sidebar"><article class="post no-comments"><h1>Boats</h1><p>{_MORE}.</p></article>
        <div class="sidebar"><p>{_LAST}</p></div></div></body>""",
        {"Boats", f"{_MORE}."},
    ),
    (  # the only articles are comments and cards
        f"""<body><div class="menu">Start</div><h1>Harvest</h1><div>{_LONG}.</div><p>So it was.</p><div>{_MORE}.</div><p>{_LAST}.</p>
        <section class="comments"><article><p>We had a poor one here, and nobody came to help us.</p></article></section>
        <div class="related"><article><a href="/1">Ten more stories</a></article></div></body>""",
        {"Harvest", f"{_LONG}.", "So it was.", f"{_MORE}.", f"{_LAST}."},
    ),
    (  # classes that say what a text is about, and some that mark a part, among words of their own
        f"""<body><nav>Start</nav><article><h1 class="form-title-big">Pumps</h1><p class="tags-intro">{_LONG}.</p><div class="form-factor"><p>{_MORE}.</p>
        <p>They are small and light.</p></div><div class="review-body">{_LAST}.</div><div class="comment-quote">It works well, he says, and so do the others that were tried.</div>
        <div class="share-this-now"><a href="/s">Send</a> <a href="/p">Print</a></div><div class="tags-below"><a href="/t">Water</a> and <a href="/u">roads</a></div>
        <div class="ad-offer-now"><a href="/o">Read on without adverts for one month</a></div></article></body>""",
        {"Pumps", f"{_LONG}.", f"{_MORE}.", "They are small and light.", f"{_LAST}.", "It works well, he says, and so do the others that were tried."},
    ),
    (
        f"""<body><div class="menu">Start</div><h1>Wells</h1><div class="search-for-water">{_LONG}.</div><p class="notice-of-rights">{_MORE}.</p><div>{_LAST}.</div>
        <div class="social-follow-us"><a href="/f">Follow</a> <a href="/g">us there</a></div><div class="footer-note-small"><a href="/h">Who we are</a></div></body>""",
        {"Wells", f"{_LONG}.", f"{_MORE}.", f"{_LAST}."},
    ),
    (  # no main element and no marks: what words and links of a block and its neighbours say
        f"""<body><div><a href="/a">News of the day from all parts of the country</a></div><div>Today</div><div><a href="/b">What else our readers liked to read this week</a></div>
        <div>Also new</div><div><a href="/c">All stories about water, roads and bridges in one place</a></div>
        <h1>Dams</h1><p>{_LONG}.</p><p>It did.</p><p>{_MORE}.</p><p>More so now.</p><p>{_LAST}.</p>
        <div><a href="/d">Ten things you did not know about the river and its banks</a></div><div>Most read</div><div><a href="/e">How to keep a cellar dry when the water comes again</a></div>
        <div>In short</div><div><a href="/f">Why the bridge will not be built before next year at least</a></div></body>""",
        {"Dams", f"{_LONG}.", "It did.", f"{_MORE}.", "More so now.", f"{_LAST}."},
    ),
    (
        f"""<body><div><a href="/a">To the first page of the paper and all of its parts</a></div><div>Best of</div><div><a href="/b">One more story about a man and his boat on the river</a></div>
        <div>{_MORE}.</div><div>Nobody knows.</div><div>{_LAST}.</div><div>So they say.</div><div>{_LONG}.</div>
        <div><a href="/c">Send this text to a friend who likes to read about rivers</a></div><div>Up next</div><div><a href="/d">The last story of the day is about rain and what it does</a></div></body>""",
        {f"{_MORE}.", "Nobody knows.", f"{_LAST}.", "So they say.", f"{_LONG}."},
    ),
]
