"""Raw records of each point-of-sale profile, built from the supplied tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.plans.bindings import FEED_DATE, Tables
from tillwork.plans.q_fields import SOURCES, TYPES, cycle
from tillwork.session import scratch_folder


PAGE_KEYS = 2500  # keys per document that lists entities


def raw_records(df: DataFrame, record_type: str, value: Column, feed_date: str = FEED_DATE, **extra: Column) -> DataFrame:
    """Records as a raw table holds them; the one-element explode builds a record's text once.

    Its struct is a column before: inside the explode Spark would interpret its expressions, not compile them.
    """
    return df.select(value.alias("_value"), *[e.alias(n) for n, e in extra.items()]).select(
        F.lit(record_type).alias("record_type"), F.explode(F.array(F.to_json("_value"))).alias("record_value"),
        F.lit(feed_date).alias("feed_date"), *extra,
    )


def twice(df: DataFrame) -> DataFrame:
    return df.unionByName(df)


def together(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def stored(t: Tables, *frames: DataFrame) -> DataFrame:
    """The records as a landing zone holds them: text written once, by record type, for queries that read it several times."""
    path = scratch_folder(t.spark, "raw")
    together(*frames).write.partitionBy("record_type").parquet(path, compression="zstd")
    return t.spark.read.parquet(path)


def text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def obj(**fields: Column) -> Column:
    return F.struct(*[v.alias(n) for n, v in fields.items()])


def amount(value: Column) -> Column:
    return obj(amount=value)


def iso(ts: Column, suffix: str = "Z") -> Column:
    return text(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), suffix)


def order_heads(t: Tables) -> DataFrame:
    """k, cu, loc, ts and cents per order."""
    k = F.col("o_orderkey")
    return t.read("orders").select(
        k.alias("k"), F.col("o_custkey").alias("cu"), text("loc", k % 25).alias("loc"), cents("o_totalprice").alias("cents"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=(k % 1440).cast("int"))).alias("ts"),
    )


def order_base(t: Tables) -> DataFrame:
    """The heads of the orders and the list of lines (pk, sk, ln, q, lc) per order.

    Shuffled once more, as the supplied tables are one file and thus one task each.
    """
    lines = t.read("lineitem").groupBy("l_orderkey").agg(
        F.collect_list(
            obj(pk=F.col("l_partkey"), sk=F.col("l_suppkey"), ln=F.col("l_linenumber"), q=F.col("l_quantity").cast("int"), lc=cents("l_extendedprice"))
        ).alias("lines")
    )
    return order_heads(t).join(lines, F.col("k") == F.col("l_orderkey"), "left").drop("l_orderkey").repartition("k")


def k() -> Column:
    return F.col("k")


def cu() -> Column:
    return F.col("cu")


def line_uid(line: Column) -> Column:
    return F.concat_ws("-", line["pk"], line["sk"], line["ln"])


def nations(t: Tables) -> DataFrame:
    return t.read("nation").withColumn("n", F.col("n_nationkey"))


def maybe(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


# ---- square -------------------------------------------------------------------------


def square_orders(t: Tables) -> DataFrame:
    pickup = F.array(obj(state=F.lit("COMPLETED"), type=F.lit("PICKUP"), pickup_details=obj(recipient=obj(email_address=text("pick", cu(), "@x.com"), phone_number=F.lit(None).cast("string")))))
    value = obj(
        id=k().cast("string"), location_id=F.col("loc"), state=cycle(k(), "COMPLETED", "COMPLETED", "OPEN", "weird"),
        created_at=iso(F.col("ts")), closed_at=maybe(k() % 9 != 0, iso(F.col("ts") + F.expr("INTERVAL 1 HOUR"))),
        customer_id=cycle(k(), text("C", cu()), "", None), source=obj(name=cycle(k(), *SOURCES)),
        total_money=amount(F.col("cents")), total_discount_money=amount(k() % 500), total_service_charge_money=amount(k() % 100),
        total_tax_money=amount(k() % 300), total_tip_money=amount(k() % 200), discounts=obj(uid=text("d", k() % 5)),
        fulfillments=maybe(k() % 5 == 0, pickup),
        tenders=F.array(obj(id=text("t", k()), type=cycle(k(), "CARD", "cash", "bitcoin"), customer_id=text("C", cu()))),
        taxes=F.array(obj(uid=text("tax", k() % 7), name=text("Tax ", k() % 7), percentage=(k() % 7).cast("string"), type=F.lit("ADDITIVE"))),
        line_items=F.transform(
            "lines",
            lambda x: obj(
                uid=line_uid(x), catalog_object_id=text("i", x["pk"]), quantity=x["q"].cast("string"), total_money=amount(x["lc"]),
                total_tax_money=amount(x["lc"] % 50), applied_taxes=F.array(obj(tax_uid=text("tax", x["pk"] % 3))),
            ),
        ),
    )
    return raw_records(order_base(t), "orders", value)


def square_locations(t: Tables) -> DataFrame:
    n = F.col("n")
    value = obj(
        id=text("loc", n), name=F.col("n_name"), type=cycle(n, "PHYSICAL", "mobile", "KIOSK", None), status=cycle(n, "INACTIVE", "ACTIVE", "ACTIVE"),
        address=obj(address_line_1=text("Street ", n), postal_code=cycle(n, text(n + 10000), text(n + 10000, "-0001"), "bad"), country=F.lit("US")),
        coordinates=obj(latitude=n + 0.5, longitude=-n - 0.25), phone_number=text("212", n), timezone=F.lit("UTC"), currency=F.lit("USD"),
        created_at=text("2020-01-", F.lpad((n + 1).cast("string"), 2, "0"), "T05:00:00-05:00"), website_url=F.lit("http://x"),
    )
    return twice(raw_records(nations(t), "locations", value))


def square_objects(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    variations = F.array(
        obj(id=text("v", p), type=cycle(p, "ITEM_VARIATION", "ITEM", "OTHER"), item_variation_data=obj(name=text("Big ", F.col("p_name"))))
    )
    item = obj(
        id=text("i", p), type=F.lit("ITEM"),
        item_data=obj(name=F.col("p_name"), description=F.col("p_brand"), category_id=text(F.col("p_type"), ",", F.col("p_brand")), variations=maybe(p % 5 != 0, variations)),
    )
    category = obj(id=F.col("p_type"), type=F.lit("CATEGORY"), category_data=obj(name=F.initcap("p_type")))
    return together(raw_records(t.read("part"), "objects", item), raw_records(t.read("part"), "objects", category))


def square_customers(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    value = obj(
        id=text("C", c), email_address=maybe(c % 5 != 0, text("hmail", c)), phone_number=maybe(c % 4 != 0, text("hphone", c)),
        given_name=maybe(c % 6 != 0, text(" Ann", c)), family_name=F.lit("Lee"), created_at=F.lit("2020-01-01T00:00:00Z"), version=text(c % 3),
    )
    return twice(raw_records(t.read("customer"), "customers", value))


def square_payments(t: Tables) -> DataFrame:
    card = obj(
        cardholder_name=cycle(k(), "Jane Doe ", "CARDHOLDER/VISA", "", None), card_brand=F.lit("VISA"), last_4=F.lpad((cu() % 10000).cast("string"), 4, "0"),
        bin=maybe(k() % 2 == 0, F.lit("400000")), exp_month=maybe(k() % 6 != 0, text(k() % 9 + 1)), exp_year=F.lit("2030"),
    )
    value = obj(id=text("t", k()), order_id=k().cast("string"), location_id=F.col("loc"), status=F.lit("COMPLETED"), card_details=obj(card=card))
    return raw_records(order_heads(t).repartition("k"), "payments", value)


# ---- toast --------------------------------------------------------------------------


def toast_orders(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    auth = obj(
        cardType=F.lit("MC"), last4CardDigits=maybe(k() % 3 == 0, text(cu() % 1000)), cardHolderFirstName=F.lit("Bo"),
        cardHolderLastName=maybe(k() % 7 != 0, F.lit("Ray ")), cardHolderExpirationMonth=F.lit("1"), cardHolderExpirationYear=F.lit("2031"),
    )
    payment = obj(
        guid=text("pay", k()), type=cycle(k(), "CREDIT", "cash", "barter"), tipAmount=(k() % 200) / 100, paymentStatus=F.lit("CAPTURED"), cardType=F.lit("VISA"),
        last4Digits=text(cu() % 100), cardHolderFirstName=none, cardHolderLastName=none,
    )
    check = obj(
        totalAmount=F.col("cents") / 100, taxAmount=(k() % 300) / 100,
        customer=maybe(k() % 4 != 0, obj(guid=text("C", cu()), email=maybe(cu() % 5 != 0, text("hmail", cu())), phone=text("hphone", cu()), firstName=F.lit("Bo"), lastName=none)),
        appliedDiscounts=F.array(obj(discountAmount=(k() % 50) / 100), obj(discountAmount=F.lit(1.0))),
        appliedServiceCharges=maybe(k() % 2 == 0, F.array(obj(chargeAmount=(k() % 10) / 10))),
        appliedPreauthInfo=auth, payments=F.array(payment),
        selections=F.transform(
            "lines",
            lambda x: obj(guid=line_uid(x), item=obj(guid=text("i", x["pk"])), quantity=x["q"].cast("double"), tax=(x["lc"] % 50) / 100, price=x["lc"] / 100, appliedTaxes=F.array(obj(guid=text("tax", x["pk"] % 3)))),
        ),
    )
    value = obj(
        guid=k().cast("string"), closedDate=maybe(k() % 9 != 0, text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), ".000+0000")),
        approvalStatus=cycle(k(), "APPROVED", "FUTURE", "NOT_APPROVED", None), diningOption=obj(guid=text("opt", k() % 5)), checks=F.array(check),
    )
    return raw_records(order_base(t), "orders", value, location_id=F.col("loc"))


def toast_references(t: Tables) -> DataFrame:
    p, none = F.col("p_partkey"), F.lit(None).cast("string")
    part = t.read("part")
    item = obj(guid=text("i", p), name=F.col("p_name"), plu=text("plu", p), optionGroups=maybe(p % 2 == 0, F.array(obj(guid=text("o", p % 10)))))
    option = obj(guid=text("o", p), name=text("Option ", p))
    groups = part.groupBy("p_type", F.floor(p / PAGE_KEYS)).agg(F.collect_set(obj(guid=text("i", p))).alias("items"))
    group = obj(name=F.col("p_type"), items=F.col("items"), optionGroups=F.array(obj(guid=text("g-", F.col("p_type")))), subgroups=F.array(obj(guid=text("s-", F.col("p_type")))))
    options = nations(t).filter("n < 5")
    dining = obj(guid=text("opt", F.col("n")), behavior=cycle(F.col("n"), "DINE_IN", "take_out", "DELIVERY", "catering", None))
    return together(
        raw_records(part, "menu-items", item, location_id=none),
        raw_records(part, "menu-option-groups", option, location_id=none),
        raw_records(groups, "menu-groups", group, location_id=none),
        twice(raw_records(options, "dining-options", dining, location_id=none)),
    )


def toast_menus(t: Tables) -> DataFrame:
    part = t.read("part").withColumn("store", F.col("p_partkey") % 25)
    page = F.floor(F.col("p_partkey") / PAGE_KEYS).alias("page")  # a menu's size does not grow with the table
    menus = part.groupBy("store", "p_brand", page).agg(
        F.collect_list(obj(salesCategory=obj(guid=F.col("p_type"), name=F.initcap("p_type")))).alias("menuItems")
    ).groupBy("store", "page").agg(F.collect_list(obj(menuItems=F.col("menuItems"))).alias("menuGroups"))
    value = obj(restaurantGuid=text("loc", F.col("store")), menus=F.array(obj(menuGroups=F.col("menuGroups"))))
    return raw_records(menus, "menus", value, location_id=F.lit(None).cast("string"))


def toast_locations(t: Tables) -> DataFrame:
    n = F.col("n")
    value = obj(
        guid=text("loc", n),
        location=obj(address1=text("Street ", n), address2=F.lit(None).cast("string"), latitude=n + 0.5, longitude=-n - 0.25, phone=text("212", n), zipCode=text(n + 10000), country=F.lit("US")),
        urls=obj(website=F.lit("http://x")), general=obj(timeZone=F.lit("UTC"), locationName=maybe(n % 2 == 0, text("Place ", n)), name=maybe(n % 3 != 0, F.col("n_name"))),
    )
    return twice(raw_records(nations(t), "restaurants", value, location_id=F.lit(None).cast("string")))


# ---- omnivore -----------------------------------------------------------------------


def omnivore_tickets(t: Tables) -> DataFrame:
    tender = obj(id=text("tt", k() % 4), name=cycle(k(), "Card", "Cash", "3rd Party", "Coupon"))
    payment = obj(id=text("pay", k()), type=F.lit("card_present"), last4=maybe(k() % 3 != 0, text(cu() % 1000)), full_name=maybe(k() % 2 == 0, text("Al ", cu())), _embedded=obj(tender_type=tender))
    value = obj(
        id=k().cast("string"), open=cycle(k(), "true", "false", "false", "false", "false"), void=cycle(k(), "false", "true", "false", "false", "false"),
        opened_at=F.unix_seconds("ts"), closed_at=maybe(k() % 9 != 0, F.unix_seconds("ts") + 3600),
        _links=obj(self=obj(href=text("https://api/1.0/locations/", F.col("loc"), "/tickets/", k()))),
        totals=obj(total=F.col("cents"), discounts=k() % 500, service_charges=k() % 100, tax=k() % 300, tips=k() % 200, sub_total=F.col("cents") - k() % 300, paid=F.col("cents")),
        _embedded=obj(
            order_type=obj(id=text("ot", k() % 7), name=cycle(k(), *TYPES)), employee=obj(id=text("e", k() % 11)),
            payments=F.when(k() % 6 == 0, F.array().cast("array<struct<id:string,type:string,last4:string,full_name:string,_embedded:struct<tender_type:struct<id:string,name:string>>>>")).otherwise(F.array(payment)),
            items=F.transform(
                "lines",
                lambda x: obj(
                    id=text("i", x["pk"]), name=text("Dish ", x["pk"]), price=x["lc"], quantity=x["q"], included_tax=x["lc"] % 50,
                    _embedded=obj(
                        modifiers=F.when(x["pk"] % 4 == 0, F.array(obj(id=text("m", x["pk"])))).otherwise(F.array().cast("array<struct<id:string>>")),
                        menu_item=obj(
                            barcodes=F.array(text("b", x["pk"]), text("c", x["pk"])),
                            _embedded=obj(menu_categories=F.array(obj(id=text("cat", x["pk"] % 6), name=F.get(F.array(*[F.lit(s) for s in ("Fast food", "Soft drinks", "Zest", "Bakery", "Grill", "Ale")]), (x["pk"] % 6).cast("int"))), obj(id=F.lit("cat9"), name=F.lit("Menu")))),
                        ),
                    ),
                ),
            ),
        ),
    )
    return raw_records(order_base(t), "tickets", value)


def omnivore_locations(t: Tables) -> DataFrame:
    n = F.col("n")
    value = obj(
        id=text("loc", n), display_name=maybe(n % 2 == 0, text("Shown ", n)), name=F.col("n_name"), website=F.lit("http://x"), status=cycle(n, "online", "offline"),
        address=obj(street1=text("Street ", n), street2=F.lit(None).cast("string"), zip=cycle(n, text(n + 10000), text(n + 10000, "-0001"), "bad"), country=F.lit("US")),
        coordinates=obj(latitude=n + 0.5, longitude=-n - 0.25), phone=text("212", n), timezone=maybe(n % 3 == 0, F.lit("America/Denver")), created_at=n * 86400 + 1577836800,
    )
    return twice(raw_records(nations(t), "locations", value))


# ---- parbrink -----------------------------------------------------------------------


def parbrink_orders(t: Tables) -> DataFrame:
    payment = obj(
        Id=F.lit(1), IsDeleted=cycle(k(), "true", None, "false").cast("boolean"), TenderId=k() % 12, CardNumber=maybe(k() % 5 != 0, text(cu() % 1000)),
        CardHolderName=cycle(k(), text("Poe / Al", cu()), "  Solo   Name ", "Half/", None), TipAmount=(k() % 200) / 100,
    )
    value = obj(
        Id=k(), Name=text("Order ", k()), BusinessDate=text(F.date_format("ts", "yyyy-MM-dd"), "T00:00:00"), ModifiedTime=maybe(k() % 9 != 0, iso(F.col("ts"), "-05:00")),
        IsClosed=cycle(k(), "true", "false", "true").cast("boolean"), DestinationId=k() % 9, EmployeeId=k() % 11, CustomerId=cu(), Tax=(k() % 300) / 100,
        Subtotal=(F.col("cents") - k() % 300) / 100, Total=F.col("cents") / 100,
        Payments=F.array(payment, obj(Id=F.lit(2), IsDeleted=F.lit(False), TenderId=F.lit(0).cast("bigint"), CardNumber=F.lit(None).cast("string"), CardHolderName=F.lit(None).cast("string"), TipAmount=F.lit(0.5))),
        Entries=F.transform(
            "lines",
            lambda x: obj(Id=line_uid(x), ItemId=x["pk"], GrossSales=x["lc"] / 100, Taxes=F.array(obj(TaxId=x["pk"] % 3, Amount=(x["lc"] % 50) / 100), obj(TaxId=F.lit(9).cast("bigint"), Amount=F.lit(1.0)))),
        ),
    )
    return raw_records(order_base(t), "orders", value, location_id=F.col("loc"))


def parbrink_destinations(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(s) for s in ("For Here", "take-out", "Uber Eats 2", "Curbside!", "Drive Thru", "Boat", "42")])
    rows = nations(t).select("n", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("d"))
    return twice(raw_records(rows, "destinations", obj(Id=F.col("d"), Name=F.get(names, F.col("d"))), location_id=text("loc", F.col("n"))))


def parbrink_tenders(t: Tables) -> DataFrame:
    rows = nations(t).select("n", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("d"))
    value = obj(Id=F.col("d"), Name=text("Tender ", F.col("d")), TenderType=F.col("d"), Active=cycle(F.col("d"), "true", "false", None).cast("boolean"), CardType=F.col("d"))
    return raw_records(rows, "tenders", value, location_id=text("loc", F.col("n")))


def parbrink_items(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    part = t.read("part").select("*", F.explode(F.array((p % 5), (p % 5) + 5)).alias("store"))
    item = obj(Id=p, Name=F.col("p_name"), ItemType=(p % 8).cast("int"), PLU=text("plu", p), IsDeleted=p % 10 == 9, IncludedModifiers=maybe(p % 2 == 0, F.array(obj(ItemId=p + 1))))
    store = text("loc", F.col("store"))
    groups = part.groupBy("store", "p_type", F.floor(p / PAGE_KEYS)).agg(F.collect_set(obj(ItemId=p)).alias("Items"))
    group = obj(Id=F.col("p_type"), Name=F.initcap("p_type"), IsDeleted=(F.col("p_type") == "PROMO"), Items=F.col("Items"))
    return together(raw_records(part, "items", item, location_id=store), raw_records(groups, "itemGroups", group, location_id=store))


def parbrink_locations(t: Tables) -> DataFrame:
    n = F.col("n")
    value = obj(
        Name=F.col("n_name"), Address1=text("Street ", n), City=maybe(n % 2 == 0, text("Own\tcity ", n)), State=maybe(n % 3 == 0, F.lit("ST")), Zip=text(n + 10000),
        Latitude=n + 0.5, Longitude=-n - 0.25, Phone=cycle(n, "(212) 456-7890", "12"), Country=F.lit("US"), TimeZone=n * 6,
    )
    return twice(raw_records(nations(t), "options", value, location_id=text("loc", n)))


def parbrink_customers(t: Tables, phone_hash) -> DataFrame:
    """Raw numbers are hashes of the seven local digits."""
    c = F.col("c_custkey")
    local = text(F.lit(4560000) + c % 10000)
    phones = F.array(obj(AreaCode=F.lit("212"), Number=phone_hash(local)), obj(AreaCode=F.lit("99"), Number=phone_hash(local)))
    value = obj(
        Id=c, EmailAddress=maybe(c % 5 != 0, text("hmail", c)), FirstName=text("Ann", c), LastName=F.lit("Lee"),
        RegistrationTime=F.lit("2020-01-01T10:00:00.25"), IsDisabled=c % 7 == 0, PhoneNumbers=maybe(c % 4 != 0, phones),
    )
    return twice(raw_records(t.read("customer"), "customers", value, location_id=F.lit(None).cast("string")))


def parbrink_house_accounts(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    store = text("loc", c % 25)
    account = obj(
        Id=c, AccountNumber=text("acc", c), Active=c % 3 != 0, Address1=text("Street ", c), Balance=F.col("c_acctbal"), City=F.lit("X"), EmailAddress=maybe(c % 5 != 0, text("hmail", c)),
        EnforceLimit=F.lit(True), FirstName=text("Ann", c), LastName=F.lit("Lee"), Limit=F.lit(100), Name=F.col("c_name"), PhoneNumber=maybe(c % 4 != 0, text("hphone", c)),
        State=F.lit("ST"), Zip=cycle(c, "12345", "12345-0001", "1"),
    )
    charge = obj(AccountId=c, OrderId=maybe(c % 2 == 0, c * 2))
    return together(
        twice(raw_records(t.read("customer"), "houseAccounts", account, location_id=store)),
        raw_records(t.read("customer"), "houseAccountsCharges", charge, location_id=store),
    )


# ---- simphony -----------------------------------------------------------------------


def simphony_checks(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    media = F.transform(
        F.array(F.lit(1)),
        lambda _: obj(aggQty=F.lit(None).cast("int"), aggTtl=F.lit(None).cast("double"), discount=none, dspQty=none, dspTtl=none, lineNum=F.lit("pay"), menuItem=F.lit(None).cast("struct<activeTaxes:string,miNum:string,prcLvl:string>"), tenderMedia=obj(tmedNum=text("tm", k() % 8), name=text("Media ", k() % 8)), rsnCodeNum=none, svcRndNum=none),
    )
    sold = F.transform(
        F.coalesce("lines", F.array().cast("array<struct<pk:bigint,sk:bigint,ln:int,q:int,lc:bigint>>")),
        lambda x: obj(
            aggQty=x["q"], aggTtl=x["lc"] / 100, discount=text("d", x["pk"] % 4), dspQty=text(x["q"]), dspTtl=text(x["lc"]), lineNum=line_uid(x),
            menuItem=obj(activeTaxes=text(x["pk"] % 3), miNum=text("i", x["pk"]), prcLvl=text(x["pk"] % 2)),
            tenderMedia=F.when(x["pk"] % 2 == 0, obj(tmedNum=text("tm", x["pk"] % 8), name=text("Media ", x["pk"] % 8))), rsnCodeNum=none, svcRndNum=text(x["ln"]),
        ),
    )
    value = obj(
        chkNum=k().cast("string"), chkName=text("Check ", k()), chkTtl=F.col("cents") / 100, opnBusDt=F.date_format("ts", "yyyy-MM-dd"), opnUTC=iso(F.col("ts")),
        clsdFlag=k() % 2 == 0, empNum=k() % 11, guestCheckId=text("g", k()), payTtl=F.col("cents") / 100, subTtl=(F.col("cents") - k() % 300) / 100, detailLines=F.concat(sold, media),
    )
    return raw_records(order_base(t), "guestChecks", value, loc_ref=F.col("loc"))


def simphony_masters(t: Tables) -> DataFrame:
    p, n = F.col("p_partkey"), F.col("n")
    part = t.read("part").withColumn("loc", text("loc", p % 25))
    stores = nations(t).withColumn("loc", text("loc", n)).select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("d"))
    d, loc = F.col("d"), F.col("loc")
    item = obj(num=text("i", p), name=F.col("p_name"), majGrpNum=F.col("p_type"), majGrpName=F.initcap("p_type"), famGrpNum=F.col("p_brand"))
    price = obj(num=text("i", p), effFrDt=F.lit("2020-01-01"), prcLvlNum=p % 3, price=F.col("p_retailprice"), rvcNum=p % 2)
    tax = obj(num=d, name=text("Tax ", d), taxRate=d * 1.5, type=text("k", d % 2))
    other = obj(num=d, name=text("Entry ", d), posPercent=d * 10)
    location = obj(locRef=loc, active=n % 3 != 0, name=F.col("n_name"))
    return together(
        raw_records(part, "menuItems", item, loc_ref=loc),
        twice(raw_records(part, "menuItemPrices", price, loc_ref=loc)),
        raw_records(stores, "taxes", tax, loc_ref=loc),
        raw_records(stores, "discounts", other, loc_ref=loc),
        raw_records(stores, "serviceCharges", other, loc_ref=loc),
        raw_records(stores, "locations", location, loc_ref=loc),
    )
