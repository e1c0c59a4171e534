"""Vocabulary of page furniture in eight languages, as RE2 fragments; features of the block tagger, not its verdict."""

#: Entries of menus and footers, by language.
NAV = {
    "en": "Home|Home page|Start page|About|About us|About Us|Contact|Contact us|Products|Services|Search|News|Events|Help|Shop|Store|Blog|Forum|Careers|Jobs|Log in|Login|Log out|Sign in|Sign up|Register|Support|Gallery|Archive|Archives|Accessibility|Newsletter|RSS|Sitemap|Site map|Imprint|Privacy|Privacy policy|Terms of use|Terms|Settings|Back to top|Back to home page|Next post|Previous post|Menu|Categories|My account|Basket|Cart|FAQ|Press|Team|Community|Downloads|Topics|Subscribe|Accept all|Reject all|Accept selected|Manage choices|Learn more|Follow us|Legal notice|Next|Previous",
    "de": "Startseite|Über uns|Kontakt|Produkte|Leistungen|Suche|Aktuelles|Nachrichten|Veranstaltungen|Hilfe|Warenkorb|Anmelden|Abmelden|Registrieren|Archiv|Impressum|Datenschutz|Datenschutzerklärung|AGB|Widerruf|Barrierefreiheit|Newsletter|Nach oben|Einstellungen|Alle akzeptieren|Alle ablehnen|Auswahl verwalten|Folgen Sie uns|Mein Konto|Karriere|Presse|Galerie|Forum|Shop|Nächster Beitrag|Vorheriger Beitrag|Sitemap|Zurück zur Startseite",
    "fr": "Accueil|À propos|Contact|Produits|Services|Recherche|Actualités|Événements|Aide|Boutique|Connexion|Déconnexion|Inscription|Archives|Panier|Plan du site|Conditions d'utilisation|Mentions légales|Confidentialité|Haut de page|Paramétrer|Tout accepter|Tout refuser|Gérer mes choix|Suivez-nous|Mon compte|Accessibilité|Newsletter|Article suivant|Article précédent|Galerie|Carrières|Presse|En savoir plus",
    "es": "Inicio|Quiénes somos|Sobre nosotros|Contacto|Productos|Servicios|Buscar|Noticias|Eventos|Ayuda|Tienda|Iniciar sesión|Cerrar sesión|Registrarse|Archivo|Carrito|Mapa del sitio|Mapa web|Condiciones de uso|Aviso legal|Privacidad|Volver arriba|Configurar|Aceptar todo|Rechazar todo|Síganos|Mi cuenta|Accesibilidad|Boletín|Más información|Galería|Empleo",
    "it": "Pagina iniziale|Home|Chi siamo|Contatti|Prodotti|Servizi|Cerca|Notizie|Eventi|Aiuto|Negozio|Accedi|Esci|Registrati|Archivio|Carrello|Mappa del sito|Condizioni d'uso|Note legali|Privacy|Torna su|Impostazioni|Accetta tutto|Rifiuta tutto|Seguici|Il mio account|Accessibilità|Newsletter|Maggiori informazioni|Galleria|Lavora con noi",
    "pt": "Página inicial|Início|Quem somos|Sobre nós|Contactos|Contacto|Contato|Produtos|Serviços|Pesquisar|Notícias|Eventos|Ajuda|Loja|Iniciar sessão|Entrar|Sair|Registar|Arquivo|Carrinho|Mapa do site|Condições de utilização|Aviso legal|Privacidade|Voltar ao topo|Definições|Aceitar tudo|Rejeitar tudo|Siga-nos|A minha conta|Acessibilidade|Newsletter|Saber mais|Galeria",
    "nl": "Startpagina|Over ons|Contact|Producten|Diensten|Zoeken|Nieuws|Evenementen|Agenda|Hulp|Winkel|Inloggen|Uitloggen|Registreren|Archief|Winkelwagen|Sitemap|Voorwaarden|Privacy|Toegankelijkheid|Naar boven|Instellingen|Alles accepteren|Alles weigeren|Volg ons|Mijn account|Nieuwsbrief|Meer informatie|Galerij|Vacatures",
    "ru": "Главная|О нас|О компании|Контакты|Товары|Продукты|Услуги|Поиск|Новости|События|Помощь|Магазин|Войти|Вход|Выйти|Регистрация|Архив|Корзина|Карта сайта|Условия использования|Конфиденциальность|Политика конфиденциальности|Наверх|Настройки|Принять все|Принять всё|Отклонить все|Подписывайтесь|Мой аккаунт|Подробнее|Галерея|Вакансии|Форум|Блог",
}
#: Headings of side columns, marks of advertisements, prompts to share, subscribe, comment or print.
PROMPT = {
    "en": "Related (?:articles|posts|stories|content)|You (?:may|might) also like|Most (?:read|popular|viewed)(?: this week| today)?|Trending(?: now)?|Tags in this section|Popular tags|Recent (?:posts|comments)|Latest news|See also|Recommended for you|More from|Advertisement|Sponsored(?: content)?|Share this(?: on social media| article| page| post)?|Share on|Print this page|Subscribe to our newsletter|Sign up for our newsletter|Get our app|Leave a (?:comment|reply)|Sign in to comment|Log in to comment|Skip to (?:main )?content|Follow us on|Comments \\(|Download our app|Read more",
    "de": "Ähnliche (?:Artikel|Beiträge)|Meistgelesen|Das könnte Sie auch interessieren|Verwandte (?:Artikel|Themen)|Anzeige|Werbung|Artikel (?:teilen|drucken)|Teilen|Seite drucken|Newsletter abonnieren|Kommentar(?:e|ieren)?(?: \\(| schreiben|$)|Zum Inhalt springen|Folgen Sie uns|Schlagwörter|Neueste Beiträge|Zum Kommentieren anmelden|Unsere App",
    "fr": "Articles similaires|Les plus lus|À lire aussi|Sur le même sujet|Publicité|Partager cet article|Partager|Imprimer|S'abonner à la newsletter|Abonnez-vous|Commentaires? \\(|Laisser un commentaire|Aller au contenu|Suivez-nous sur|Mots-clés|Téléchargez notre application|Connectez-vous pour commenter",
    "es": "Artículos relacionados|Lo más leído|También le puede interesar|Te puede interesar|Publicidad|Compartir(?: este artículo| en)?|Imprimir|Suscríbase al boletín|Suscríbete|Comentarios \\(|Dejar un comentario|Deje un comentario|Saltar al contenido|Síganos en|Etiquetas|Descargue nuestra aplicación|Inicie sesión para comentar",
    "it": "Articoli correlati|I più letti|Potrebbe interessarti|Leggi anche|Pubblicità|Condividi(?: questo articolo| su)?|Stampa|Iscriviti alla newsletter|Commenti \\(|Lascia un commento|Vai al contenuto|Seguici su|Etichette|Scarica la nostra app|Accedi per commentare",
    "pt": "Artigos relacionados|Mais lidas|Mais lidos|Leia também|Também lhe pode interessar|Publicidade|Partilhar(?: este artigo)?|Compartilhar|Imprimir|Subscrever a newsletter|Comentários \\(|Deixe um comentário|Deixar um comentário|Ir para o conteúdo|Siga-nos|Etiquetas|Descarregue a nossa aplicação",
    "nl": "Gerelateerde artikelen|Meest gelezen|Lees ook|Dit vindt u misschien ook leuk|Advertentie|Deel dit artikel|Delen|Afdrukken|Abonneer op de nieuwsbrief|Schrijf u in|Reacties \\(|Laat een reactie achter|Plaats een reactie|Naar de inhoud|Volg ons op|Trefwoorden|Download onze app",
    "ru": "Похожие (?:статьи|материалы)|Самое читаемое|Читайте также|Вам может понравиться|Реклама|Поделиться(?: статьёй| статьей)?|Распечатать|Версия для печати|Подписаться на рассылку|Подпишитесь|Комментарии \\(|Оставить комментарий|Перейти к содержанию|Мы в соцсетях|Метки|Теги|Скачайте наше приложение|Войдите, чтобы комментировать",
}
#: Headings after which a list of other pages usually follows.
HEADING = "Related (?:articles|posts|stories)|You (?:may|might) also like|Most (?:read|popular|viewed)(?: this week| today)?|Tags in this section|Recent posts|Latest news|Recommended for you|Ähnliche (?:Artikel|Beiträge)|Meistgelesen|Das könnte Sie auch interessieren|Articles similaires|Les plus lus|À lire aussi|Artículos relacionados|Lo más leído|También le puede interesar|Articoli correlati|I più letti|Leggi anche|Artigos relacionados|Mais lid[ao]s|Leia também|Gerelateerde artikelen|Meest gelezen|Lees ook|Похожие (?:статьи|материалы)|Самое читаемое|Читайте также"
#: Notices about cookies and data: the page speaks of its own storing of data.
COOKIE = "(?:uses?|use of|accept|enable|verwende[nt]|Verwendung von|utilise|utilisation d[eu]s?|utiliza|uso de|utilizza|l'uso de[i]|gebruik(?:t|en)|использу\\S+|использовани\\S+) (?:[\\p{L}]+ ){0,3}?(?:cookies?|Cookies?|i cookie|файл\\S* cookie)|(?:cookies?|Cookies?) (?:to improve|propias|policy|settings|consent)|(?:política|politique|politica) d[eei] cookies?|cookiebeleid|Cookie-(?:Richtlinie|Einstellungen)|privacy matters to us|(?:partners?|partenaires|Partner|socios|partner|parceiros|partners|партн\\S+) (?:[\\p{L}]+ ){0,3}?(?:store|stockons|speichern|almacenamos|archiviamo|armazenamos|slaan|храним|guardamos|memorizziamo|bewaren|сохраня\\S+)|(?:Reject all|Accept selected|Alle akzeptieren|Alle ablehnen|Tout accepter|Aceptar todo|Accetta tutto|Aceitar tudo|Alles accepteren|Принять вс[её])"
#: Footers: owner and year, rights, registered office, the system that made the page.
FOOTER = "(?:^|[^\\p{L}])(?:©|\\(c\\)|Copyright) ?(?:\\(c\\) |© )?(?:19|20)\\d\\d|All rights reserved\\.|Alle Rechte vorbehalten|Tous droits réservés|Todos los derechos reservados|Tutti i diritti riservati|Todos os direitos reservados|Alle rechten voorbehouden|Все права защищены|Registered office|Powered by [A-Z]|(?:^|[^\\p{L}])(?:Bereitgestellt von|Réalisé avec|Propulsé par|Realizado con|Desarrollado con|Realizzato con|Desenvolvido com|Mogelijk gemaakt door|Работает на) "
#: What stands between the entries of a menu or breadcrumb.
SEPARATOR = "[|·•»›>/–—-]+"


def any_of(lists: dict[str, str]) -> str:
    """All alternatives, longest first (RE2 takes the first alternative that matches)."""
    return "|".join(sorted({x for v in lists.values() for x in v.split("|")}, key=len, reverse=True)) if lists is NAV else "|".join(lists.values())


NAV_ANY = any_of(NAV)
PROMPT_ANY = any_of(PROMPT)
