"""Log lines shared by tests."""

CONTENT = [
    '{"ZT_content":[{"ZT_leaf_video":[{"ctype":"1"},{"ctype":"2"}]},'
    '{"ZT_leaf_video":[{"ctype":1}]}]}',
    '{"ZT_content":[{"ZT_leaf_video":[{"ctype":""},{"ctype":null},{}]}]}',
    '{"ZT_content":[]}',
    '{"other":1}',
    "{bad",
]

PAGES = {
    "n1": '{"header":{"fileTime":"2023-04-05 09:41:18","contentsTime":"2023-02-01 08:40:00",'
    '"fileContents":"a/NAV.json"},"body":{"cards":[{"id":"P1","source":"s1","title":"t1"},'
    '{"id":"P9","title":"t9"},{"title":"noid"}]}}',
    "p1": '{"header":{"fileTime":"2023-04-05 09:41:19","contentsTime":"2023-02-01 08:41:00",'
    '"fileContents":"a/b/P1.json"},"body":{"cards":[{"id":"c1","source":"x","title":"y"},'
    '{"id":"c2","title":"z"}]}}',
    "p2": '{"header":{"fileTime":"2023-04-05 09:41:19","contentsTime":"2023-02-01 08:41:00",'
    '"fileContents":"a/P2.json"},"body":{"cards":[{"id":"c3"}]}}',
    "u1": '{"header":{"fileTime":"2023-04-05 09:41:19"}}',
    "u2": '{"x":1}',
    "b1": "{bad",
}
