"""Sentences that are neither in the labelled table nor in the test tables; personal data stands in {type: ...}.

The table was widened and the lean of the field set while looking at what was missed here, so they are a
development set: recall on them is higher than on text never looked at.
"""

SENTENCES = """
Reach out to {name: Maria Gonzalez} if the badge reader fails.
{name: Dr. Ahmed Hassan} will present on the second day.
{name: Jonathan Pruitt} chaired the committee for six years.
The invoice was approved by {name: Siobhan Kavanagh} in a hurry.
I left the parcel with {name: Mr. Okonkwo} downstairs.
{name: Priya} wondered if the heating was on.
Does anyone know where {name: Tobias} went?
My neighbour {name: Ingrid Solberg} feeds the cat.
Tell {name: Hank} that the van is here.
{name: Lucia Ferraro} and {name: P. Hartwell} cannot come.
Write to {email: anna.weber@web.de} by Friday.
{email: j.doe@gmail.com} is full again.
The list admin is {email: maria.gonzalez@example.com}, I believe.
We got a bounce from {email: support-team@north-wind.co.uk} this morning.
Ping {email: k_olsen99@fastmail.fm} once it compiles.
Use {email: lee (at) quarry (dot) org} for anything urgent.
The old one, {email: tom dot baker at rivermill dot net}, is dead.
Ring the porter on {phone: 020 7946 0321} if you are locked out.
My desk line is {phone: (212) 555-0188}.
Text {phone: +1 415 555 2671} when you land.
For refunds dial {phone: 800-555-0144}.
The courier's number was {phone: 07911 123456}.
Leave word at {phone: five five five oh one seven three}.
Her passport, {id_number: C01X00T47}, was stolen.
Enter {id_number: 219-09-9999} as the social security number.
The tax number {id_number: 12/345/67890} is on the form.
My national insurance number is {id_number: QQ 12 34 56 C}.
Ship it to {address: 48 Larkspur Road, Hatherby} by courier.
The clinic sits at {address: 1600 Willow Avenue}.
He rents {address: Flat 7, 22 Mornington Crescent, Eastham} with a friend.
Letters go to {address: P.O. Box 418, Denwick} only.
{name: Frau Keller} hat angerufen und fragt nach dem Schlüssel.
Sag bitte {name: Matthias Vogel}, dass der Aufzug wieder fährt.
{name: Annegret Schumann} übernimmt die Spätschicht.
Gestern war {name: Herr Yilmaz} im Lager.
Der Kurs wird von {name: Katrin} gehalten.
Schreib doch an {email: buero@hausverwaltung-nord.de}.
Die Rückfragen beantwortet {email: jens.petersen@mail.de}.
Ihr Anschluss ist {phone: 030 12345678}.
Am besten die {phone: +49 171 2345678} wählen.
Im Notfall hilft {phone: 0221/476523}.
Auf dem Ausweis steht {id_number: L01X00T47}.
Als Steuernummer habe ich {id_number: 21/815/08150} notiert.
Das Paket liegt in der {address: Lindenstraße 14, 50674 Köln}.
Sie zieht in den {address: Birkenweg 3}.
{name: Madame Lefèvre} a laissé un message.
Je vais voir {name: Étienne Marchand} demain.
{name: Sylvie Roche} s'occupe du planning.
On attend encore {name: Guillaume}.
Répondez à {email: contact@librairie-du-port.fr} avant midi.
Vous avez {email: c.moreau@orange.fr} en copie.
Le standard, c'est le {phone: 01 42 68 53 00}.
Composez le {phone: +33 6 12 34 56 78} en cas de panne.
Le numéro de sécurité sociale est {id_number: 2 84 05 75 116 042 18}.
Le siège est au {address: 17 rue de Verneuil}.
Rendez-vous au {address: 5 bis, avenue de Breteuil}.
{name: Doña Mercedes Iglesias} firmó el acta.
Mañana viene {name: Álvaro Quintana} a revisar la caldera.
{name: Rocío Benítez} presentó las cuentas.
Avisa a {name: Gonzalo} de que hay corte de agua.
Responde a {email: pedidos@ferreteria-lopez.es} hoy.
Copia a {email: r.benitez@correo.es} también.
El fijo de la tienda es {phone: +34 915 551 234}.
Marque el {phone: 612 345 678} si hay avería.
Con el DNI {id_number: 53120983H} basta.
Mi número de NIE es {id_number: X4821973K}.
La fiesta es en {address: calle Olmo 27}.
Trabajo en {address: avenida Miraflores 102}.
The {d} copies went to room 4021 on the 3rd of May 2024.
Order 5512-0098 contains 3,450,000 washers and 12 crates.
The Willow Creek plant closes in August, the Port Salter one in June.
Project Bluestem was cancelled, so Marketing kept the budget.
Mark the corners, then rose petals may follow, will they not?
Version 4.18.2207 listens on port 8080 from 09:30 to 17:45.
Grace under pressure is what the April review called for.
Der Ausschuss hat den Haushalt für Juni beschlossen, Punkt 4 entfällt.
Die Werkstatt in Neu Brandow prüft die Bremsen und den Motor.
Wer im Mai Urlaub nimmt, trägt ihn in die Liste ein.
Le comité a voté le budget de juin, point 4 reporté.
Le dossier 4471-2093 est chez le service juridique depuis avril.
La comisión aprobó el presupuesto de junio, punto 4 aplazado.
El pedido 7731-0042 sigue en el almacén desde abril.
[SPEAKER_03] Somebody has to water the plants on Thursday.
[DOOR CLOSES] Who left the ladder in the Harbour Room?
""".strip().splitlines()
