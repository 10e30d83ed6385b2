"""A small labelled table for the block classifier: invented pages whose blocks say what they are.

A block that begins with ``+`` belongs to the main text, one with ``-`` does
not; the mark is taken off before features are made. The pages cover the usual
layouts (semantic tags, plain divisions with class names, no structure at all).
"""

_LONG = "the committee met on the second day and spoke at length about the bridge, its cost and the people who would cross it every morning on their way to work."
_MID = "They agreed to meet again in spring."
_LINKS = "".join(f'<li><a href="/{w}">- {w}</a></li>' for w in ("home", "news", "sport", "about us", "contact"))

PAGES = [
    # semantic layout, lists of links, an advert before the article
    f'<header><p>- The Daily Page</p></header><nav><ul>{_LINKS}</ul></nav><div class="ad">- Buy one and get the second one at half the price today only.</div>'
    f"<article><h1>+ A bridge for the town</h1><p>+ {_LONG}</p><p>+ Yes.</p><p>+ {_MID}</p><ul><li>+ The first arch is of stone</li><li>+ The second is of wood</li></ul><p>+ {_LONG}</p></article>"
    "<aside><h3>- Most read</h3><p>- Ten tips for a better garden that you can try this weekend with your family.</p></aside><footer>- &copy; example.org, all rights reserved. Printed in the north of the country.</footer>",
    f"<nav>- Menu</nav><article><p>+ {_MID}</p></article><footer><p>- {_MID}</p></footer>",
    f'<article><h1>+ Short</h1><p>+ Rain.</p></article><div class="ad">- {_LONG}</div><footer>- {_LONG}</footer>',
    f'<article><h1>+ Links within</h1><p>+ {_LONG} <a href="x">more words here</a></p><p>+ <a href="y">A whole line that is a link</a></p><p>+ No.</p></article><aside><p>- <a href="z">Another story</a></p></aside>',
    # short last blocks, short blocks of links and one-word blocks inside an article stay
    f"<article><h1>+ Ends soon</h1><p>+ {_LONG}</p><p>+ End.</p></article>",
    f'<article><p>+ One.</p><p>+ <a href="t">Two</a></p><p>+ Three</p></article>',
    f'<div class="article"><p>+ <a href="t">Two words</a></p><p>+ {_LONG}</p><p>+ <a href="u">Source</a></p></div>',
    f'<main><p>+ Word</p><p>+ <a href="u">Linked word</a></p></main>',
    # a header inside the article, reader comments and share bars inside it too
    f'<main><article><header><h1>+ Inside header</h1></header><p>+ {_LONG}</p><p>+ {_MID}</p><div class="share">- <a href="s">Share this</a></div><section class="comments"><h2>- 3 comments</h2><p>- {_LONG}</p><p>- I agree.</p></section></article></main><footer>- Imprint</footer>',
    # divisions with class names
    f'<div id="header"><div class="logo">- Village Voice</div></div><div class="menu"><ul>{_LINKS}</ul></div><div id="content"><h1>+ Flood</h1><p>+ {_LONG}</p><p>+ {_MID}</p><p>+ So it was.</p></div>'
    f'<div class="sidebar"><p>- {_LONG}</p><p>- Weather: mild</p></div><div id="footer"><p>- All rights reserved by the owners of this page and their friends.</p></div>',
    f'<div class="cookie-notice"><p>- We use cookies so that this page works well and to learn how it is read by you and others.</p></div><div class="post-body"><p>+ {_LONG}</p><p>+ {_MID}</p></div><div id="comments"><div class="comment"><p>- {_LONG}</p></div><div class="comment"><p>- Nice!</p></div></div>',
    f'<div class="entry-content"><h2>+ A recipe</h2><p>+ {_MID}</p><ol><li>+ Cut the bread</li><li>+ Eat it</li></ol><div class="newsletter"><form><label>- Your address</label><p>- Sign up for letters from us every week or every month as you like.</p></form></div><p>+ {_LONG}</p></div>',
    f'<div class="breadcrumb">- <a href="/">home</a> / <a href="/a">town</a></div><div class="story"><p>+ {_LONG}</p><blockquote>+ {_MID}</blockquote></div><div class="related"><ul>{_LINKS}</ul><p>- {_MID}</p></div><div class="promo">- {_LONG}</div>',
    # no structure at all: words, links and neighbours decide
    f'<div>- <a href="/">home</a> | <a href="/n">news</a></div><p>+ {_LONG}</p><p>+ {_LONG}</p><p>+ {_MID}</p><p>+ {_LONG}</p><div>- <a href="/i">imprint</a> <a href="/p">privacy</a></div>',
    f'<table><tr><td>- <a href="/1">one</a></td><td>- <a href="/2">two</a></td></tr></table><p>+ {_LONG}</p><p>+ {_MID}</p><p>+ {_LONG}</p><p>- <a href="/next">next page</a></p><p>- Contact</p>',
    f"<p>+ {_LONG}</p><p>+ {_LONG}</p>",
    f"<p>+ {_LONG}</p><p>+ {_MID}</p>",
    f"<p>+ {_MID}</p>",
    f'<form><p>- Search this page for words that you would like to find in it</p></form><p>+ {_LONG}</p><p>+ {_MID}</p><p>+ {_LONG}</p>',
    f'<main><h1>+ In main</h1><p>+ {_MID}</p><p>+ Done.</p><form><p>- {_MID}</p></form></main><div role="contentinfo">- {_MID}</div><dialog><p>- {_LONG}</p></dialog>',
    f'<div role="banner">- {_MID}</div><div role="navigation"><ul>{_LINKS}</ul></div><div role="main"><p>+ {_LONG}</p><p>+ Soon.</p></div><div role="complementary"><p>- {_LONG}</p></div>',
    # a head without an end, the article inside elements named after the layout, formulas
    f"<html><head><title>Not shown</title><meta charset=utf-8><body><nav><ul>{_LINKS}</ul></nav><article><p>+ {_LONG}</p><p>+ {_MID}</p></article><footer>- {_MID}</footer>",
    f'<div class="layout right-sidebar"><article><h1>+ In a layout</h1><p>+ {_LONG}</p><p>+ Short.</p></article><div class="sidebar"><p>- {_LONG}</p></div></div>',
    f'<main class="content has-sidebar"><h1>+ Beside it</h1><p>+ {_LONG}</p><p>+ Let <math><mi>x</mi></math> be a number.</p><aside><p>- {_MID}</p></aside></main>',
    f'<div class="comment-list"><article class="comment-body"><p>- {_LONG}</p></article></div>',
    # names inside an article that are only those of its parts; furniture that is never closed
    f'<article><div class="post-header"><h1>+ A title</h1></div><h2 id="related-work">+ Related work</h2><p>+ {_LONG}</p><section id="login"><h2>+ To log in</h2><p>+ {_MID}</p></section>'
    f'<section class="section-header"><h2>+ Part two</h2></section><p class="form-text">+ {_MID}</p><dl class="tags"><dt>+ Tag</dt><dd>+ {_MID}</dd></dl><ol class="footnotes"><li>+ {_MID}</li></ol>'
    f'<ul class="share-links">{_LINKS}</ul><ol class="comment-list"><li>- {_LONG}</li></ol></article>',
    f"<nav><ul>{_LINKS}</ul><article><h1>+ After an open menu</h1><p>+ {_LONG}</p><p>+ {_MID}</p></article><footer>- {_MID}</footer>",
]
