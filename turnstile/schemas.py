"""Raw record schemas, one per entity, as DDL text.

``VARIANT`` marks fields whose JSON type differs from record to record. Rich text is kept
as JSON text because its depth is unbounded.
"""

from __future__ import annotations

from pyspark.sql import types as T

_ADDRESS = """struct<formattedAddress:string, city:string, country:string, subdivision:string,
 postalCode:string, streetAddress:struct<number:string, name:string, apt:string>,
 geocode:struct<latitude:double, longitude:double>>"""
_PLAIN_ADDRESS = """struct<formatted:string, city:string, country:string, subdivision:string,
 postalCode:string>"""
_MONEY = "struct<amount:variant, currency:string>"
_SHOWN_MONEY = "struct<amount:string, formattedAmount:string>"
_PERSON_ADDRESS = """struct<firstName:string, lastName:string, email:string, phone:string,
 company:string, address:string, city:string, state:string, zipCode:string, countryCode:string>"""
_ANSWERS = "array<struct<inputName:string, value:variant, values:array<string>>>"

RAW_DDL: dict[str, str] = {
    "events": f"""
        id string, title string, slug string, status string, shortDescription string,
        detailedDescription string,
        categories struct<categories:array<struct<name:string>>>,
        dateAndTimeSettings struct<startDate:string, endDate:string, timeZoneId:string,
            recurrenceStatus:string, formatted:struct<dateAndTime:string>>,
        location struct<name:string, type:string, address:{_ADDRESS}>,
        registration struct<type:string, status:string, tickets:struct<currency:string,
            lowestPrice:struct<value:string>, highestPrice:struct<value:string>,
            soldOut:boolean>>,
        mainImage struct<url:string, id:string, width:bigint, height:bigint>,
        createdDate string, updatedDate string, publishedDate string, instanceId string,
        userId string, guestListSettings struct<displayedPublicly:boolean>,
        onlineConferencing struct<enabled:boolean, type:string>,
        calendarUrls struct<google:string, ics:string>, eventPageUrl variant,
        description string""",
    "guests": """
        id string, eventId string, contactId string, guestType string, rsvpId string,
        orderNumber string, ticketNumber string,
        tickets array<struct<definitionId:string, number:string, name:string>>,
        attendanceStatus string,
        additionalDetails struct<orderStatus:string, rsvpStatus:string, archived:boolean>,
        secondaryLanguageCode string, createdDate string, updatedDate string,
        guestDetails struct<name:struct<first:string, last:string>, email:string, phone:string,
            checkedIn:boolean,
            formResponse:struct<inputValues:array<struct<inputName:string, value:string>>>,
            member:struct<id:string>>""",
    "contacts": """
        id string, revision bigint, createdDate string, updatedDate string,
        primaryInfo struct<email:string>,
        info struct<name:struct<first:string, last:string>,
            emails:struct<items:array<struct<email:string, primary:boolean, tag:string>>>,
            phones:struct<items:array<struct<phone:string>>>,
            extendedFields:struct<items:map<string,string>>>,
        picture struct<url:string, width:bigint, height:bigint>,
        primaryEmail struct<subscriptionStatus:string, deliverabilityStatus:string>,
        memberInfo struct<memberId:string, status:string, emailVerified:boolean,
            signupDate:string, profileInfo:struct<nickname:string, privacyStatus:string>,
            userInfo:struct<role:string, userId:string>>,
        source struct<sourceType:string, appId:string>""",
    "members": """
        id string, loginEmail string, status string, privacyStatus string,
        activityStatus string,
        profile struct<nickname:string, slug:string, photo:struct<url:string>,
            cover:struct<url:string>, title:string, firstName:string, lastName:string>,
        contactId string, createdDate string, updatedDate string, lastLoginDate string""",
    "tickets": f"""
        ticketNumber string, eventId string, orderNumber string, ticketDefinitionId string,
        name string, policy string, free boolean, archived boolean, orderArchived boolean,
        orderStatus string, orderFullName string, guestFullName string, email string,
        guestEmail string, memberId string, contactId string,
        price struct<value:variant, amount:variant, currency:string>, checkIn variant,
        checkInUrl string, ticketPdfUrl string, form struct<inputValues:{_ANSWERS}>,
        createdDate string, _createdDate string""",
    "ticket_definitions": """
        id string, eventId string, revision bigint, name string, description string,
        hidden boolean,
        pricingMethod struct<pricingType:string, fixedPrice:struct<value:string, currency:string>,
            guestPrice:struct<value:string, currency:string>,
            pricingOptions:struct<options:array<struct<name:string>>>>,
        free boolean, feeType string, salePeriod struct<startDate:string, endDate:string>,
        displayNotOnSale boolean, saleStatus string,
        salesDetails struct<unsoldCount:bigint, soldCount:bigint, reservedCount:bigint,
            soldOut:boolean>,
        initialLimit bigint, actualLimit bigint, limitPerCheckout bigint,
        createdDate string, _createdDate string, updatedDate string, _updatedDate string""",
    "order_summaries": f"""
        event_id string, event_title string,
        summary struct<sales:array<struct<total:{_MONEY}, revenue:{_MONEY},
            totalOrders:bigint, totalTickets:bigint>>>""",
    "event_orders": """
        orderNumber string, eventId string, reservationId string, snapshotId string,
        contactId string, memberId string, firstName string, lastName string, email string,
        fullName string, status string, confirmed boolean, archived boolean,
        anonymized boolean, channel string, method string, ticketsQuantity bigint,
        ticketsPdf string, fullyCheckedIn boolean,
        tickets array<struct<ticketName:string, name:string, ticketNumber:string,
            number:string, price:variant>>,
        transactionId string,
        paymentDetails struct<transaction:struct<method:string, transactionId:string,
            scheduledAction:string>, priceSummary:struct<subtotal:variant, total:variant,
            tax:variant, discount:variant, fees:variant, currency:string>>,
        giftCardPaymentDetails array<string>, availableActions array<string>,
        created string, createdDate string, updated string, updatedDate string""",
    "payments": f"""
        transactionId string, providerTransactionId string, appId string, createdAt string,
        amount struct<amount:string, currency:string>, platformFee string, status string,
        type string, provider string, providerName string, paymentMethod string,
        paymentMethodData struct<PaymentMethodDataType:string, network:string,
            lastFour:string, maskedCreditCard:string, creditCardExpiryMonth:string,
            holderName:string, bin:string, installments:bigint>,
        providerDashboardLink string, cashierError struct<failureCode:string>,
        refundability struct<isRefundable:boolean, reason:struct<value:string>>,
        refunds array<struct<status:string, amount:string, createdAt:string, type:string,
            reason:string, providerRefundId:string>>,
        order struct<id:string, description:struct<appOrderId:string, appBuyerId:string,
            billingAddress:{_PERSON_ADDRESS}, shippingAddress:{_PERSON_ADDRESS},
            items:array<struct<id:string, name:string, quantity:bigint, price:string>>,
            additionalCharges:struct<tax:string, shipping:string, discount:string>,
            subscription:struct<status:string, frequency:string, interval:bigint,
                billingCycles:bigint>>>""",
    "store_orders": f"""
        id string, number string, checkoutId string,
        buyerInfo struct<id:string, email:string, firstName:string, lastName:string,
            phone:string>,
        buyerLanguage string, billingInfo struct<address:{_PLAIN_ADDRESS}>,
        paymentStatus string, fulfillmentStatus string,
        pricingSummary struct<subtotal:{_SHOWN_MONEY}, total:{_SHOWN_MONEY},
            tax:{_SHOWN_MONEY}, shipping:{_SHOWN_MONEY}, discount:{_SHOWN_MONEY}>,
        currency string,
        lineItems array<struct<productName:variant,
            catalogReference:struct<catalogItemId:string>, quantity:bigint,
            price:struct<amount:string>>>,
        appliedDiscounts array<struct<coupon:struct<code:string>>>,
        channelInfo struct<type:string>,
        shippingInfo struct<logistics:struct<
            shippingDestination:struct<contactDetails:struct<firstName:string,
                lastName:string, phone:string>, address:{_PLAIN_ADDRESS}>,
            selectedCarrierServiceOption:struct<title:string, code:string>>>,
        createdDate string, updatedDate string, customFields array<string>,
        archived boolean, activities array<string>""",
    "store_transactions": """
        orderId string, id string, status string, paymentMethod string,
        amounts struct<total:string>, currency string""",
    "rsvps": f"""
        id string, eventId string, contactId string, memberId string, rsvpStatus string,
        checkInStatus string, firstName string, lastName string, email string,
        guestNames array<string>, additionalGuests bigint, totalGuests bigint,
        formResponse struct<inputValues:{_ANSWERS}>, createdDate string,
        _createdDate string, updatedDate string, _updatedDate string""",
    "form_submissions": """
        id string, _id string, formId string, namespace string, status string,
        submitter struct<contactId:string, memberId:string>, createdDate string,
        _createdDate string, updatedDate string, _updatedDate string, seen boolean,
        submissions map<string,variant>""",
    "coupons": """
        id string, name string, code string, active boolean, expired boolean,
        specification struct<type:string, name:string, moneyOffAmount:double,
            percentOffRate:double, fixedPriceAmount:double, freeShipping:boolean,
            scope:struct<namespace:string, group:struct<name:string, entityId:string>>,
            minimumSubtotal:double, limitedToOneItem:boolean,
            appliesToLowestPriceItem:boolean, startTime:string, expirationTime:string>,
        limitPerCustomer bigint, numberOfUsages bigint, dateCreated string""",
    "automations": """
        id string, name string, description string, status string, origin string,
        applicationInfo struct<appDefId:string>,
        configuration struct<trigger:struct<triggerKey:string, appId:string>,
            actions:array<struct<actionKey:string, appId:string>>>,
        createdDate string, _createdDate string, updatedDate string, _updatedDate string""",
}


def raw_schema(entity: str) -> T.StructType:
    """Schema of one raw entity."""
    return T.StructType.fromDDL(" ".join(RAW_DDL[entity].split()))
