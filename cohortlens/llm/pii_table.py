"""The small labelled table that the sequence model for personal data learns from; invented sentences, marked in place.

``{kind|words}`` marks personal data; all other words are labelled O. Half of the sentences hold numbers that are none.
"""

LABELLED = """\
Write to {email|anna.berg@mail.example} before noon.
Mail {email|j.doe+news@corp.example.org} or call {phone|+49 (30) 901820-11}.
Contact: {email|müller@bücher.example} for a copy.
My address is {email|root@localhost} on that box.
Her mail was {email|Ines_Paz@uni.example.es} then.
Send it to <{email|sales@shop.example.com}>, please.
E-mail {email|tom.lee77@web.example.net} and wait.
Reply to {email|postmaster@intranet} if it fails.
You can reach {email|karin@firma.example.de} all day.
Ask {email|bob99@x1.example.com} about the {email|admin@host} box.
Call {phone|+1 (212) 555-0147} after six.
Phone {phone|(415) 555-0188} or leave a note.
Tel. {phone|030 / 901820} in the morning.
Ring me at {phone|+44 20 7946 0958} tomorrow.
Phone: {phone|212-555-0133} ask for Ana.
His mobile is {phone|+34 600 123 456} now.
tel {phone|0171 5550199} oder schreiben.
Call us on {phone|1-800-555-0199} today.
Fax {phone|+33 1 70 18 99 00} est en panne.
The number is {phone|555.010.4477} he said.
Paid with card {card|4111 1111 1111 1111} yesterday.
Card {card|5500-0000-0000-0004} was refused.
Visa {card|4012.8888.8888.1881} expires soon.
card number {card|378282246310005} on file.
Charge {card|6011000990139424} for the rest.
Credit card: {card|3530/1113/3330/0000} please.
Login from {ip|192.168.10.4} at night.
The server {ip|10.0.0.254} is down.
Host {ip|2001:db8::8a2e:370:7334} did not answer.
Blocked {ip|203.0.113.77} and {ip|198.51.100.9} today.
address {ip|fe80::1ff:fe23:4567:890a} of the router.
From {ip|172.16.254.1:8080} came nothing.
The meeting is on 2021-03-04 at 10:30 in room 12.
It cost 1,299.00 or 12 % less in 2019.
See section 4.2.1 and table 17 of the report.
Version 10.4.2 of 12.11.2020 is out.
He ran 5000 m in 13:37.02 and won.
Order 100045 holds 3 parts at 19.99 each.
In 1989 about 340000 people lived there.
The key is a94f8c0d3b77e21f6c09d3e1 and the hash 0x7fe3a9.
Item 12 of 340 was sold for 45.
token=9f8e7d6c5b4a39281706 was in the log.
"id": 48151623420815 is only a row number.
Page 3 of 9, line 120 to 144.
Follow @anna and @the_team for news.
Cost at 5 @ 3.50 each was fine.
Chapter 2. 3. and 4. are short.
ISBN 978-3-16-148410-0 is a book.
The matrix is 3x3 and x1 is 0.5 of x2.
Account 00012345678 was closed in May 2020.
Time 1617181920 is a stamp.
Lat 52.5200 and long 13.4050 are Berlin.
In 12 of 80 cases 1st and 2nd agree.
ghp1A2b3C4d5E6f7G8h9 is a secret, AKIA99X8Y7Z6 too.
Of 2400 words, 85 were new; 7 were not."""
