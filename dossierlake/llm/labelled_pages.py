"""Small labelled pages from which the weights of ``extract`` are counted.

A page is a list of (markup, 1 if its words belong to the main text). All of them are invented.
"""

PAGES: list[list[tuple[str, int]]] = [
    [
        ("<head><title>A walk</title><style>p{}</style><script>var a=1</script></head>", 0),
        ('<header class="site-header"><a href="/">Home</a><a href="/b">Boats</a></header>', 0),
        ('<nav class="main-menu"><ul><li><a href="/n">News</a></li><li><a href="/w">Work</a></li></ul></nav>', 0),
        ('<div class="cookie-notice">This site stores crumbs.<button>Fine</button></div>', 0),
        ('<div class="site wrapper"><main><article><header><h1>A walk by the river</h1></header>', 1),
        ("<p>We set out at dawn and the fog lay low over the water.</p>", 1),
        ("<p>Nobody spoke until the <b>old mill</b> came into sight.<br>Then the dog barked.</p>", 1),
        ('<div class="ad">Buy boots today.</div>', 0),
        ('<div class="advert banner">Boots at half price.</div>', 0),
        ('<p>By noon we had crossed both bridges and sat down to <a href="/e">eat</a>.</p></article></main></div>', 1),
        ('<section class="comments" id="comments"><div class="comment">Lovely story.</div></section>', 0),
        ('<aside class="sidebar"><ul><li><a href="/x">Older walks</a></li></ul></aside>', 0),
        ("<footer>Copyright the walkers.</footer>", 0),
    ],
    [
        ("<head><title>Soup</title></head>", 0),
        ('<div id="top-menu" class="menu"><a href="/a">All</a> <a href="/s">Soups</a></div>', 0),
        ('<div class="breadcrumb breadcrumbs"><a href="/">Start</a> <a href="/s">Soups</a></div>', 0),
        ('<div class="post-content entry"><h2>Onion soup</h2><p>Slice the onions thinly and melt the butter.</p>', 1),
        ("<ul><li>Four onions of middling size</li><li>A spoon of flour</li></ul><ol><li>Chop</li><li>Fry</li></ol>", 1),
        ("<p>Stir for half an hour. Add broth and let it simmer.</p><blockquote>Patience is the salt.</blockquote>", 1),
        ("<table><tr><td>Time</td><td>One hour</td></tr></table></div>", 1),
        ('<form class="newsletter subscribe"><label>Mail</label><input name="m"><button>Send</button></form>', 0),
        ('<div class="related promo"><a href="/1">Leek soup</a><a href="/2">Pea soup</a></div>', 0),
        ('<div class="share social"><a href="/f">Pass on</a></div>', 0),
        ('<div id="disqus_thread" class="comment-list"><p>I added thyme.</p></div>', 0),
        ('<div class="site-footer"><p>Made in a small kitchen.</p></div>', 0),
        ("<noscript>Please switch scripts on.</noscript>", 0),
    ],
    [
        ('<nav role="navigation"><a href="/">Index</a><a href="/t">Tides</a></nav>', 0),
        ('<div role="banner" class="header topbar">The Harbour Post</div>', 0),
        ('<div class="alert notice" role="alert">The ferry is late.</div>', 0),
        ('<div id="content" class="article-body"><h1>High tide</h1><p>The <a href="/m">moon</a> drew the sea up the steps.</p>', 1),
        ("<div><p>Two boats broke loose and the <em>harbour master</em> ran.</p></div>", 1),
        ("<h3>Afterwards</h3><p>It was quiet again.</p><pre>07:40 high water</pre></div>", 1),
        ('<div class="sponsored sponsor ads">Rope and tar, best quality.</div>', 0),
        ('<div class="widget sidebar-box related"><ol><li><a href="/l">Low tide</a></li></ol></div>', 0),
        ('<div class="popup modal consent cookie">We keep crumbs. <a href="/c">More</a></div>', 0),
        ('<form action="/find"><input><select><option>Sea</option><option>Land</option></select></form>', 0),
        ('<div class="comments respond"><p>Was there too.</p><form><textarea>Say something</textarea></form></div>', 0),
        ('<aside class="promo newsletter">Tides by mail.</aside>', 0),
        ('<footer class="footer"><ul><li><a href="/i">Imprint</a></li></ul></footer>', 0),
    ],
    [
        ('<header><div class="logo">Bee News</div><nav><a href="/h">Hives</a></nav></header>', 0),
        ('<section class="banner advertisement ad">Honey jars.</section>', 0),
        ('<div class="popup newsletter signup subscribe">A letter each month.</div>', 0),
        ("<article><h1>The swarm</h1><section><p>In May the old queen leaves with half the hive.</p></section>", 1),
        ('<figure><img src="/b"><figcaption>A swarm on a pear tree</figcaption></figure>', 1),
        ('<p>They wait in a <a href="/c">cluster</a> while <a href="/s">scouts</a> look for a hollow.</p>', 1),
        ('<footer class="tags"><a href="/t">bees</a></footer>', 0),
        ("</article>", 1),
        ('<div class="notice consent">Terms have changed.</div>', 0),
        ('<div class="share social alert"><button>Like</button></div>', 0),
        ('<div class="breadcrumbs breadcrumb menu topbar"><a href="/">Home</a></div>', 0),
        ('<div class="sponsor sponsored advertisement advert ads modal signup">Smokers.</div>', 0),
        ('<div class="widget"><ul class="menu"><li><a href="/o">Older</a></li></ul></div>', 0),
        ('<div id="respond"><h3>Write to us</h3></div><div class="disqus">Nice bees.</div>', 0),
        ("<template><p>Row</p></template><iframe>frame</iframe><noscript>off</noscript>", 0),
        ("<footer>Bees since 1901.</footer><script>x()</script>", 0),
    ],
]
