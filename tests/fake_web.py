"""A transport without a network: what a url says is what it gives."""

import re


def get(url, timeout):
    if "missing" in url:
        return 404, {}, b""
    if "busy" in url:
        return 503, {}, b""
    if "seq=" in url or "date=" in url:
        at = int(re.search(r"seq=(\d+)", url)[1]) if "seq=" in url else 5
        if at > 12:
            return 500, {}, b""
        page = lambda n: (
            f'<div class="page" data-seq="{n}" data-page="{100 + n}" data-date="1951-02-{5 + n // 6:02d}"><p>before</p><p>MR. A: said {n}</p><p>and on</p><p>DR. B:</p></div>'
        )
        return 200, {}, f'<div class="transcript-text" data-from-seq="{at}" data-to-seq="{at + 3}">{"".join(page(n) for n in range(at, at + 4))}</div>'.encode()
    return 200, {"content-type": "text/html; charset=iso-8859-1"}, "<p>Müller</p>".encode()
