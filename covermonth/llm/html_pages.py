"""A small labelled table for the block classifier.

Each page is invented. A `+` or `-` starts a new block's label: + main text, - not. Labels are in page
order, one for each block that the splitter finds.
"""

# Fixed values: (html, labels of its blocks)
LABELLED: list[tuple[str, str]] = [
    (
        "<html><head><title>News</title></head><body><header><div>The Daily Paper</div>"
        "<p>Independent since 1901</p></header><nav><a href='/'>Home</a> <a href='/w'>World</a></nav>"
        "<article><h1>Storm reaches the coast</h1><p>By A. Writer</p><p>Heavy rain fell over the whole coast during "
        "the night, and several roads were closed until the morning after trees had come down.</p>"
        "<p>Nobody was hurt.</p><p>Officials said that the <a href='/d'>dam</a> held, and that water levels were "
        "falling again by noon.</p></article><aside><h3>Most read</h3><ul><li><a href='/1'>One story</a></li>"
        "<li><a href='/2'>Another story</a></li></ul></aside><footer><p>Copyright The Daily Paper. All rights "
        "reserved by the publishers of this site and their partners.</p></footer></body></html>",
        "---+++++----",
    ),
    (
        "<body><nav><ul><li><a href='a'>alpha</a></li><li><a href='b'>beta</a></li><li><a href='c'>gamma</a></li></ul></nav>"
        "<div class='ad'>Buy two, get one free until Sunday in every shop of the town.</div>"
        "<article><h1>A short note</h1><p>Yes.</p><p>It was a long day, and at its end we had learned little that was new "
        "to any of us, though some pretended.</p><p>No.</p></article>"
        "<footer>&copy; example &middot; a short sentence about nothing.</footer></body>",
        "----++++-",
    ),
    (
        "<body><div id='cookie-notice'><p>We use cookies to give you the best experience on our site.</p>"
        "<button>Accept</button></div><div id='content'><h2>How bread is made</h2><p>Flour, water, salt and time are all "
        "that a loaf needs; the rest is patience and a hot oven.</p><ul><li>Mix the flour and the water.</li>"
        "<li>Let it rest for an hour.</li></ul><blockquote>Bread is slow.</blockquote></div>"
        "<div class='sidebar'><p>Subscribe to our weekly letter and never miss a recipe from our kitchen.</p></div></body>",
        "--+++++-",
    ),
    (
        "<body><main><h1>Rivers</h1><p>A river begins as a spring, gathers other streams on its way, and ends in a lake or the "
        "sea.</p><table><tr><td>Nile</td><td>6650 km</td></tr></table><p>See <a href='x'>the list of rivers</a>.</p>"
        "<section class='comments'><h3>Comments</h3><p>I have seen this river twice and it was brown both times, "
        "sadly.</p><p>Great text, thanks!</p></section></main></body>",
        "+++++---",
    ),
    (
        "<body><p>Plain pages have no marks at all, but their text is long enough that nobody would take it for a menu or "
        "a note at the foot.</p><p>They go on for several paragraphs, each of which has many words and hardly any link "
        "to another page of the site.</p><p><a href='1'>Back</a> | <a href='2'>Next</a> | <a href='3'>Index</a></p></body>",
        "++-",
    ),
    (
        "<body><div><a href='1'>Products</a></div><div><a href='2'>Prices</a></div><div><a href='3'>About us</a></div>"
        "<div>The engine was built in the spring of that year by four people who had never before made anything larger than "
        "a clock.</div><div>It ran for eleven minutes.</div><div>After that they spent two years on finding out why it had "
        "stopped, and another one on making it run again.</div><div><a href='4'>Terms</a> <a href='5'>Privacy</a></div></body>",
        "---+++-",
    ),
    (
        "<body><article><header><h1>Letters</h1><p>12 May</p></header><p>Dear all, the letters of this spring were many, and "
        "we can print only a part of them here.</p><form><label>Your name</label><p>Write to us with your opinion on what "
        "you have read in this issue.</p></form><p>We thank everybody.</p><div class='share'><a href='s'>Share</a></div>"
        "<aside>Related: how letters were written a hundred years ago and why nobody does so now.</aside>"
        "<footer><a href='t'>Tags</a></footer></article></body>",
        "+++--+---",
    ),
    (
        "<body><div><p>Welcome to the pages of our garden club, which has met every week for forty years.</p></div>"
        "<article><h1>Roses</h1><p>Cut them in March, when the frost is over, and give them what they need.</p><p>Water "
        "daily.</p></article><div><p>The club meets on Monday evenings in the old town hall, and guests are welcome at "
        "any time.</p><p>Write to us.</p></div></body>",
        "-+++--",
    ),
    (
        "<body><div class='x1'><p>Win a trip for two to the sea with the coupon below.</p></div><main><p>Nobody knew who had "
        "built the bridge, or when, or why it led nowhere.</p><p>It was gone by May.</p></main><div class='x2'>"
        "<p>All our prices include tax, and none of them the postage.</p></div></body>",
        "-++-",
    ),
    (
        "<body><p>First.</p><p>Then came the rain.</p><h2>Later</h2><p>We sat inside and played cards.</p><p>Nobody won.</p>"
        "<p>It was dark by four.</p><p>So we slept.</p><p>The end.</p></body>",
        "++++++++",
    ),
    (
        "<body><div class='cookie-banner'><p>This site stores small files on your device, which tell us how often you come "
        "back, which pages you read to their end, and which of our advertisements you look at; you can refuse them in the "
        "settings of your browser at any time.</p></div><article><p>Snow.</p><p>It fell all night and the whole day after, "
        "and covered the fences, the well, and at last the windows of the house.</p></article><section id='comments'>"
        "<p>We had the same winter here, four hundred miles to the south, and the trains did not run for a whole week, "
        "so that in the end even the post was carried on skis.</p><p>Lovely story, and so well told that I read it to my "
        "children twice, and they asked for it again the next evening and the evening after that.</p></section>"
        "<aside><p>Also in this issue: how the old stoves were built, what was burned in them, and why so few of them "
        "have been left in the houses of the valley to this day.</p></aside><footer><p>All texts and pictures belong to their "
        "authors; nothing may be printed again without a letter from the editors, who can be reached at the address "
        "below on every working day.</p></footer></body>",
        "-++----",
    ),
    (
        "<body><div><p>Good morning.</p><p>The train was late again.</p><p>A man read to us from his paper.</p></div><div>"
        "<p>At noon we arrived.</p><p>The sea!</p></div></body>",
        "+++++",
    ),
    (
        "<body><header><p>The quarterly of the society for the study of small things, founded in the year of the great flood "
        "by seven friends and still printed by hand in the same two rooms.</p></header><div class='newsletter'><p>Leave us your "
        "address and we will send you, once a month and never more often, a short letter on what has been found, lost "
        "and found again in our cabinets.</p></div><main><p>Ants.</p><p>They keep to their roads.</p><p>A stone in the way "
        "is passed on the left by some and on the right by others, and nobody has found out why.</p></main>"
        "<div class='related-posts'><p>Last month we wrote about the beetles of the northern dunes, their songs, and the "
        "winter in which all of them were silent from the first frost to the last.</p></div></body>",
        "--+++-",
    ),
    (
        "<body><div class='menu'><p>Start</p><p>Contact</p></div><div class='post-content'><p>Small.</p><p>Bees find their way "
        "home by the sun, and on dull days by what they remember of the land below them.</p><h2>Sources</h2>"
        "<p><a href='1'>A book on bees</a></p></div><div class='banner'><p>Honey from our own hives, now at half the price in "
        "our shop around the corner.</p></div><div role='contentinfo'><p>Imprint of the site and of its owner, who lives "
        "in a village.</p></div></body>",
        "--++++--",
    ),
    (
        "<body><div class='site-header'><p>Notes from the harbour</p></div><div class='content-sidebar-wrap'><main>"
        "<header class='entry-header'><h1>The lighthouse</h1><p>3 June</p></header><p>It was built in two summers, of stone "
        "that came by boat, and its lamp burned oil until the year of the great storm.</p><p>Now it is dark.</p></main>"
        "<div class='sidebar-primary'><p>Boats leave for the island at nine and at noon, if the sea allows it.</p></div></div>"
        "<div class='footer-widgets'><p>Harbour office, open on weekdays.</p></div></body>",
        "-++++--",
    ),
    (
        "<body><div class='layout-sidebar-right'><article><header class='entry-header'><h1>Clay</h1></header><div class='"
        "post-header-image'><p>Clay is found wherever water has stood still for long enough to let go of what it carried.</p>"
        "</div><p>Dig it in autumn.</p><div class='share-buttons'><p>Tell your friends</p><p>Send by mail</p></div>"
        "<div class='related-posts'><p>Glazes</p><p>The kiln that we built in the yard and what became of it.</p></div>"
        "</article></div></body>",
        "+++----",
    ),
    (
        "<body><div class='site-header'><p>The walking club</p></div><div class='main-menu'><p><a href='1'>Walks</a></p>"
        "<p><a href='2'>Members</a></p></div><p>We met at the station at eight, in the rain, and nobody thought of going home "
        "again before the first hill.</p><p>It cleared up.</p><p>By noon we saw the sea from the ridge, and the boats that "
        "came in with the tide.</p><div class='sidebar-right'><p>Next walk</p><p>Sunday</p></div><div class='footer-links'><p>"
        "<a href='3'>Imprint</a></p></div></body>",
        "---+++---",
    ),
    (
        "<body><div class='content-with-sidebar'><p>The mill has stood since the days when the river still turned two wheels, "
        "and its stones are those of the first miller.</p><p>It grinds rye on Mondays and wheat on all other days, as long as "
        "the water is high enough to reach the sluice.</p></div><div class='site-footer'><p>Write to us</p><p>Legal</p></div>"
        "</body>",
        "++--",
    ),
    (
        "<body><div class='top-banner'><p>Free post this week</p></div><article><div class='post-header'><h2>Wool</h2><p>By a "
        "shepherd</p></div><p>Sheep are shorn in May, before the flies come, and the fleece is washed in the brook.</p><div "
        "class='banner-text'><p>Dry it slowly.</p><p>Then card it.</p></div><p>Spin it in winter.</p><div class='social-links'>"
        "<p>Follow the flock</p><p>See us at the market of the town on the first Sunday.</p></div><div class='comment-area'><p>"
        "Lovely sheep, and a lovely dog with them, who looked as if it knew the way better than all of us.</p><p>Thanks!</p>"
        "</div></article><div class='widget-area'><p>The farm shop</p><p>Open daily</p></div></body>",
        "-++++++------",
    ),
    (
        "<body><div class='header-bar'><p>Clock tower museum</p><p>Tickets</p></div><div><p>The clock was made by a smith who "
        "could not read, and it has been late by four minutes ever since he died.</p><p>No one has mended it.</p><p>Visitors "
        "are shown the wheels, the weights and the bell, which is struck by hand on feast days.</p></div><div class="
        "'menu-bottom'><p>Opening hours</p><p>Ways to reach us</p></div><div class='sponsor-list'><p>The bank of the town</p>"
        "<p>Friends of the tower</p></div></body>",
        "--+++----",
    ),
    (
        "<body><div class='page-sidebar-left'><div><p>The ferry crosses the lake twice a day, and in winter only when the ice "
        "has been broken by the men of the village.</p><p>Whoever misses it walks around the shore, which takes the better "
        "part of a day and two pairs of dry socks.</p></div></div><div class='footer-nav'><p><a href='1'>Fares</a></p><p>"
        "<a href='2'>Weather</a></p></div></body>",
        "++--",
    ),
    (
        "<body><main><div class='notice-board'><h2>Honey</h2><p>In June.</p><p>The combs are cut when the bees have closed "
        "them.</p></div><p>It keeps for years.</p><div class='related-links'><p>Wax candles</p><p>Mead and how it is made in "
        "the valley.</p></div></main></body>",
        "++++--",
    ),
    (
        "<body><div class='cookie-bar'><p>We and those who pay for this site would like to remember your visit, and ask that you "
        "let us do so for a year.</p></div><div class='site-header'><p>The almanac of the northern valleys, in which every "
        "farmer finds the days for sowing, mowing and the first fire in the stove.</p></div><article><p>Frost in May.</p><p>It "
        "took the plums and the early pears.</p><p>The apples had not yet opened, and those that stood by the wall bore as in "
        "any other year.</p></article><div class='newsletter-form'><p>Have the almanac sent to your house each month, with the "
        "weather that is to come and some that has already been.</p></div><div class='footer-text'><p>Printed since the days "
        "of our grandmothers by the same family, on paper made from rags that the neighbours bring to us.</p></div></body>",
        "--+++--",
    ),
    (
        "<body><h1>Salt</h1><p>It was dear.</p><p>Men carried it over the pass.</p><p>Each had a mule.</p><h2>The toll</h2>"
        "<p>A tenth was paid at the bridge.</p><p>Some went by night.</p><p>The toll ended with the railway.</p></body>",
        "++++++++",
    ),
]
