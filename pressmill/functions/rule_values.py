"""Ordered error rules, stated as data.

Each table lists its rules in the order they are tried.  A rule is
``(label, tests)``; all its tests must hold.  A test is ``(field, kind, values)``
with ``field`` one of ``url``, ``text`` and ``kind`` one of

* ``any``     at least one value occurs in the field
* ``all``     every value occurs in the field
* ``equals``  the field equals one of the values
* ``ends``    the field ends with one of the values

``text`` is always the lower-cased page text; ``url`` keeps its case.  The
expressions are compiled in :mod:`pressmill.functions.rules`.
"""

# Every label gets this prefix in results.
LABEL_PREFIX = "ERROR: "

# ---------------------------------------------------------------------------
# Labels and needles below must equal the values they were
# specified with, or results change.  Known oddities are kept and marked.
# ---------------------------------------------------------------------------

ARCHIVED = "Article has been archived"
BLOCKED = "Blocked from website"
COOKIES = "Must enable cookies to access site"
FORBIDDEN = "403 Forbidden"
LEGAL = "451 Unavailable for legal reasons"
NOT_ENGLISH = "Not in English"
NOT_FOUND = "Article not found"
NOT_SCRAPABLE = "Not scrapable content"
NO_PAGE = "404 Page not found"
NO_TEXT = "No text gathered"
PAYWALL = "Article behind a paywall or login page"
VIDEO = "Video/ Image content only"

# Rules on the URL alone; the last rule that matches gives the label.
URL_RULES = [
    ("Website is no longer maintained", [("url", "any", [
        "www.examiner.com", "liberalplug.com", "o4anews.com",
        "leftwingnation.org", "learnprogress.org", "forwardprogressives.com",
        "anotherdayintheempire.com", "teapartytribune.com", "madpatriots.com",
        "winningdemocrats.com", "hermancain.com", "gloria.tv",
        "viralliberty.com", "usanewsflash", "conservativedailyreview.com",
        "readconservatives.news", "politicalsitenews.com", "usatwentyfour.com",
        "ufpnews.com", "kinjaroundup.kinja.com", "sourcesnews.com",
        "hillary4prisoner.com", "hangthebankers.com", "patriothangout.com",
        "bloodyrubbish.com", "conservative101.com", "dailyrushbo.com",
        ".ozy.comliveleak.com",  # two hosts run together; kept as specified
        "the-daily-record", "departedmedia.com",
    ])]),
    (VIDEO, [("url", "any", [
        "www.youtube.com/watch", "instagram.com", "pinterest.com",
        "https://xkcd.com/", "//youtu.be/", "photos.prnewswire.com",
        "worldstarhiphop.com/videos/video", "flickr.com", "beta.prx.org",
    ])]),
    (VIDEO, [("url", "ends", [".jpg"])]),
    (NOT_SCRAPABLE, [("url", "any", [
        "farminguk.com", "google.com/maps/", "google.com/search?",
        "http://www.bbc.co.uk/programmes/", "insideedition.com/videos/",
        "itunes.apple.com", "slideshare.net", "docs.google.com",
        "nymag.com/tags/", "documentcloud.org/documents", "photos.google.com",
    ])]),
    (VIDEO, [("url", "all", ["msnbc", "watch"])]),
    (NOT_ENGLISH, [("url", "any", [
        "ir.voanews", "paper.li", "hani.co.kr", "destentor.nl",
        "thenewsdoctors.com",
    ])]),
    ("Content is a pdf", [("url", "any", [".pdf"])]),
    (COOKIES, [("url", "any", ["calciomercato.com", "shadowandact.com"])]),
]

# Rules on the page text; the last rule that matches gives the label.
PAGE_TEXT_RULES = [
    ("401 Authorization Required", [("text", "any", [
        "401 authorization required",
        "user is not authorized to perform this action",
    ])]),
    (FORBIDDEN, [("text", "any", [
        "403 forbidden", "403 error", "403 - forbidden",
    ])]),
    (FORBIDDEN, [("text", "equals", ["forbidden", "403"])]),
    (NO_PAGE, [("text", "equals", [
        "looks like something went wrong.",
        "something went wrong. wait a moment and try again.",
    ])]),
    (NO_PAGE, [("text", "equals", [" blacklisted news favorites"])]),
    (NO_PAGE, [("text", "any", [
        "page not found", "was not found on this server",
        "https status: 404 (not found)", "http status: 404 (not found)",
        "Error 503",  # capital letter, so it never matches; kept as specified
        "page unavailable", "page cannot be displayed.", "404 not found",
        "404: not found",
        "the gallery you're looking for is no longer up-to-date",
        "feed address: http error (code) and message: (404) null",
        "post not available", " view the current page or another snapshot:",
        "reference #18.", "search privacy notice", "404 - file not found",
        '"status" : 404',
        "username or email address remember me  lost your password? ← go to fellowship of the minds",
    ])]),
    (NO_PAGE, [("text", "equals", ["not found"])]),
    ("406 Not Acceptable", [("text", "equals", ["not acceptable"])]),
    ("406 Not Acceptable", [("text", "any", ["406 not acceptable"])]),
    ("410 Deleted", [("text", "any", ["410 deleted by author"])]),
    (LEGAL, [("text", "any", [
        "content not available in your", "451: unavailable",
        "is not available in your region",
        "unable to allow international traffic",
        "is not available in your country",
        "451 unavailable for legal reasons",
        "currently unavailable in most european countries",
        "is not currently available in your location",
    ])]),
    ("502 gateway error", [("text", "any", [
        "reported a bad gateway error", "502 bad gateway",
    ])]),
    (ARCHIVED, [("text", "any", ["this content has been removed"])]),
    (PAYWALL, [("text", "any", [
        "the advocatesubscription panel", "full story, subscribe now",
        "fellowship of the minds",
        "the web browser you are using does not support modern websites. you are using an outdated browser. please upgrade your browser to improve your experience.",
        "please wait while we attempt to load the request page",
        "please login below or register an account",
    ])]),
    (NOT_FOUND, [("text", "any", [
        "please correct the error and try again",
        "please visit to new hosted site", "this page is missing",
        "the page you requested is unavailable", "article not found",
        "for some reason reddit can't be reached",
        "this page is currently unavailable",
        "aus irgendeinem grund kann reddit leider nicht erreicht werden.",
        "sorry, we can’t seem to find the page you’re looking for",
        "page which is currently unavailable",
        "sorry, we couldn't find that page.",
        "your request resulted in an error",
    ])]),
    (BLOCKED, [("text", "any", ["blocked your ip"])]),
    (BLOCKED, [("text", "equals", ["too many requests"])]),
    (BLOCKED, [("text", "any", [
        "whitelist your ip", "bot protection firewall", "access denied",
        "you were blocked",
        "refresh the page or contact the site owner to request access. c",
        "request unsuccessful", "potential automated action detected",
        "blocked your ip",
        "refresh the page or contact the site owner to request access. copy and paste the ray id when you contact the site owner",
        "the action you just performed triggered the security solution",
        "sorry but something about this request looked a bit suspicious, and we block suspicious",
    ])]),
    ("Client-Side Exception", [("text", "any", ["client-side exception"])]),
    ("Connection Issue", [("text", "any", [
        "an unknown connection issue between cloudflare and the origin web server",
    ])]),
    ("Internal Server Error", [("text", "any", ["internal server error"])]),
    ("Mod_Security server-side error", [("text", "any", [
        "this error was generated by mod_security",
    ])]),
    (COOKIES, [("text", "any", [
        "enable javascript and cookies to continue", "enable javascript",
        "please enable js", "ensure javascript is enabled",
        "please enable cookies and reload the page. completing the captcha proves you are a human",
    ])]),
    ("Provided host name is not valid for this server", [("text", "any", [
        "the provided host name is not valid for this server.",
    ])]),
    ("Server side connection error", [("text", "any", [
        "server temporarily unavailable",
    ])]),
    (VIDEO, [("text", "any", ["\nvia youtube"])]),
]

# A rule whose result is the page text itself instead of a label.
KEEP_PAGE_TEXT = None

# Rules for pages without paragraph text; the last rule that matches wins.
EMPTY_PAGE_RULES = [
    (FORBIDDEN, [("url", "any", ["pantsonfirenews.com"])]),
    (LEGAL, [("url", "any", ["fox2now.com/news", "ktla.com/news/"])]),
    (NO_PAGE, [("text", "equals", [" "])]),
    (VIDEO, [("url", "all", ["mediamatters.org", "clips"])]),
    (VIDEO, [("url", "any", ["theepochtimes.com"]), ("text", "any", ["epoch video"])]),
    (KEEP_PAGE_TEXT, [("url", "any", ["chinadaily.com.cn"])]),
    (NOT_SCRAPABLE, [("url", "any", ["gmanetwork.com", "ecowatch"])]),
    (NO_PAGE, [("url", "any", [
        "feeds.foxnews.com/", "pjmedia.com/blog", "weny.com",
        "americantoday.news", "supremepatriot.com", "highschoolsports.al.com",
        "www.philly.com", "rightalert.com/", "InfiniteUnknown/",
        "newsbreakapp.com",
    ])]),
    (ARCHIVED, [("url", "any", [
        "delmarvanow.com", "fosters.com", "seacoastonline.com",
        "capecodtimes.com", "recordnet.com", "www.progress-index.com",
        "gainesville.com", "www.dispatch.com", "nwfdailynews.com",
        "theledger.com", "ocala.com", "tuscaloosanews.com", "newsherald.com",
        "citizenfreepress.com", "www.blufftontoday.com", "newschief.com",
        "kuow.org", "southernkitchen.com", "telegram.com",
        "providencejournal.com", "staugustine.com", "cjonline.com",
        "lubbockonline.com", "www.heraldnews.com/", "columbiadailyherald",
        "jsonline.com", "jacksonville.com", "houmatoday.com", "zerohedge.com",
        "heraldtribune.com", "rssfeeds.azcentral.com", "uticaod.com",
        "rssfeeds.cincinnati.com", "palmbeachpost.com",
        "palmbeachdailynews.com", "enterprisenews.com",
        "rssfeeds.burlingtonfreepress", "waynedupree.com",
        "patriotledger.com", "recordonline.com", "heraldnews.com",
        "southcoasttoday.com", "dailycommercial.com", "sj-r.com",
        "pjstar.com", "hollandsentinel.com", "feeds.bizjournals.com",
        "timesonline", "progress-index", "tauntongazette", "metrowestdaily",
        "norwichbulletin.com", "savannahnow.com", "breakingtimes.com",
        "northjersey.com", "news-journalonline", "goerie.com",
        "southcoasttoday", "vvdailypress", "sentinel-standard",
        "eveningtribune", "blufftontoday", "amestrib.com", "goupstate.com",
        "mystatesman.com", "onlineathens", "statesman", "rrstar.com",
        "cantonrep.com", "thetimesnews", "starnewsonline.com",
        "obama.trendolizer",
    ])]),
    (NOT_FOUND, [("text", "any", [
        "sorry, we can’t seem to find the page you’re looking for",
        "page which is currently unavailable", "temporary unavailable. sorry!",
        "sorry, we couldn't find that page.",
        "your request resulted in an error", "default backend - 404",
    ])]),
    (NOT_FOUND, [("url", "any", [
        "unleashthebeef.com", "the-review", "dailycommerical.com",
        "mrcblog.com", "fayobserver.com", "liberalmountain.com",
        "upstract.com", "israelnationalnews.com", "commdiginews.com",
        "ranker.com", "ipolitics.ca", "forums.hannity.com", "bients.com",
    ])]),
    (BLOCKED, [("text", "any", [
        "whitelist your ip", "bot protection firewall", "access denied",
        "you were blocked", "request unsuccessful",
        "potential automated action detected", "blocked your ip",
        "the action you just performed triggered the security solution",
        "sorry but something about this request looked a bit suspicious, and we block suspicious",
    ])]),
    (VIDEO, [("url", "any", [
        "limportant.fr", "feeds.bet.com/~r", "wkyufm.org", "gma/videos/",
        "/videos/", "wnyc.org", "/gallery/", "/video/", "nbcwashington.com",
        "wlrn.org", "forbes.com/pictures/", "issuu.com/",
        "rssfeeds.usatoday.com", "espn.go.com/espnradio/", "/video/",
    ])]),
]

# Rules tried after EMPTY_PAGE_RULES gave nothing; here the first match wins.
LAST_RESORT_RULES = [
    (NO_PAGE, [("url", "any", ["wral.com"])]),
    (VIDEO, [("url", "any", ["kake"])]),
    (PAYWALL, [("url", "any", ["post-gazette.com"])]),
    (VIDEO, [("url", "any", ["grabien"])]),
    (NOT_FOUND, [("url", "any", ["israelnationalnews"])]),
    (NOT_FOUND, [("url", "any", ["avoiceformen"])]),
]
